"""The Merkle manifest against a plain Python tree, on messy, empty and one-sided tables."""
import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(*values):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(digests, fanout):
    """(root, path of each leaf) by lists."""
    paths, nodes, at = [[] for _ in digests], list(digests), list(range(len(digests)))
    while len(nodes) > 1:
        for i, path in enumerate(paths):
            lo = at[i] // fanout * fanout
            path.append(("".join(nodes[lo:at[i]]), "".join(nodes[at[i] + 1:lo + fanout])))
        nodes = [H(*nodes[i:i + fanout]) for i in range(0, len(nodes), fanout)]
        at = [i // fanout for i in at]
    return nodes[0], paths


def plain_proofs(rows, fanout):
    """{(digest, subroot, path)} with the root, of (tree, id, digest)."""
    first = lambda v: (v is not None, v if v is not None else 0)
    trees = sorted({r[0] for r in rows}, key=lambda t: (t is not None, (t or "").encode()))
    parts = {t: sorted((r for r in rows if r[0] == t), key=lambda r: (first(r[1]), r[2])) for t in trees}
    built = {t: plain_tree([r[2] for r in parts[t]], fanout) for t in trees}
    root, above = plain_tree([built[t][0] for t in trees], fanout)
    out = [(r[2], built[t][0], tuple(p + above[i])) for i, t in enumerate(trees) for r, p in zip(parts[t], built[t][1])]
    return root, sorted(out)


def spark_proofs(df, fanout=8):
    manifest = merkle.build(df, "lang", ["doc_id"], fanout)
    got = merkle.proofs(manifest, fanout).collect()
    return manifest, sorted((r.digest, r.subroot, tuple((s.left, s.right) for s in r.path)) for r in got)


def leaves(docs):
    return docs.select("doc_id", "lang", merkle.leaf_digest(*(docs[c] for c in ("doc_id", "source", "lang", "n_chars", "text"))).alias("digest"))


@pytest.mark.parametrize("fanout", [2, 8])
def test_messy_rows_equal_brute_force(messy, fanout):
    rows = [(r.lang, r.doc_id, leaf_of(r.doc_id, r.source, r.lang, r.n_chars, r.text)) for r in messy.collect()]
    manifest, got = spark_proofs(leaves(messy), fanout)
    root, expected = plain_proofs(rows, fanout)
    assert manifest.root == root and got == expected


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 9}, {"a": 65, None: 1}, {"a": 3, "": 1, "b": 8, None: 64}, {str(i): 1 + i % 3 for i in range(70)}])
def test_shapes_of_trees(workers, sizes):
    rows = [(t, i, H(f"{t}/{i}")) for t, n in sizes.items() for i in range(n)]
    df = workers.createDataFrame([(i, t, d) for t, i, d in rows], "doc_id int, lang string, digest string")
    manifest, got = spark_proofs(df)
    root, expected = plain_proofs(rows, 8)
    assert manifest.root == root and got == expected


def test_copies_of_one_row_and_null_ids(workers):
    rows = [("x", None, H("same"))] * 200 + [("x", 1, H("one")), ("x", 1, H("two"))]
    df = workers.createDataFrame([(i, t, d) for t, i, d in rows], "doc_id int, lang string, digest string").repartition(5)
    manifest, got = spark_proofs(df)
    root, expected = plain_proofs(rows, 8)
    assert manifest.root == root and got == expected


def test_labels_are_nested(workers):
    df = workers.range(150).select(F.col("id").alias("doc_id"), F.lit("x").alias("lang"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    nodes = [r for r in merkle.nodes(merkle.build(df, "lang", ["doc_id"])).collect() if not r.above]
    levels = {k: sorted((r.lo, r.hi) for r in nodes if r.level == k) for k in range(4)}
    assert [len(levels[k]) for k in range(4)] == [150, 19, 3, 1] and levels[3] == [(0, 150)]
    for k in range(3):
        assert all(sum(lo <= a and b <= hi for lo, hi in levels[k + 1]) == 1 for a, b in levels[k])


def test_folding_tells_tampered_rows(messy):
    texts = messy.select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text"))
    manifest = merkle.build(texts.select("doc_id", "lang", merkle.leaf_digest(F.col("text")).alias("digest"), "text"), "lang", ["doc_id"])
    for r in merkle.proofs(manifest).select(
            "text", merkle.folded(F.col("digest"), F.col("path")).alias("same"),
            merkle.folded(merkle.leaf_digest(F.lower("text")), F.col("path")).alias("lower")).collect():
        assert r.same == manifest.root and (r.lower == manifest.root) == (r.text == r.text.lower())


def test_empty(empty):
    manifest, got = spark_proofs(leaves(empty))
    assert manifest.root is None and got == []
