"""Operators made of columns only: sharding, mixing, line dedup, quality rules."""
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from compare import as_rows, connect
from conftest import EXTRA
from tidemark.llm import line_dedup, mixing, oracles, quality_rules, sharding
from tidemark.llm.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"


def same(df, con, sql):
    ours = as_rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    theirs = as_rows([d[0] for d in result.description], result.fetchall())
    assert ours[0] == theirs[0]
    assert Counter(ours[1]) == Counter(theirs[1])


def duck_of(df, name):
    con = duckdb.connect()
    con.register("given", df.toArrow())
    con.execute(f"create table {name} as select * from given")
    return con


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query_equals_its_sql(workers, name):
    same(QUERIES[name](workers, FOLDER), connect(FOLDER), oracles.ORACLES[name])


# ---------- sharding ----------

def minimax(sizes, shards):
    """Smallest capacity by trying all, for a short list of sizes."""
    def fits(capacity):
        used, room = 1, capacity
        for s in sizes:
            if s > room:
                used, room = used + 1, capacity
            room -= s
        return used <= shards
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low


def test_cuts_are_the_minimax_ones(spark):
    import random
    for seed, count, shards in ((1, 300, 7), (2, 40, 24), (3, 9, 4), (4, 1, 3)):
        rng = random.Random(seed)
        groups = sorted((rng.getrandbits(63), rng.choice([1, 5, 9, 200])) for _ in range(count))
        cuts = sharding.cut_hashes(spark.createDataFrame(groups, "h long, bytes long"), shards)
        loads = [0] * (len(cuts) + 1)
        for h, size in groups:
            loads[sum(h >= c for c in cuts)] += size
        assert len(loads) <= shards
        assert max(loads) == minimax([s for _, s in groups], shards)


def check_shards(rows, texts, shards):
    slots, home = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(shards))
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts)


def test_shards_of_messy_rows(messy, empty):
    rows = sharding.shard(messy, 5).collect()
    check_shards(rows, [(r.doc_id, r.text) for r in messy.select("doc_id", "text").collect()], 5)
    crc = zlib.crc32(messy.where("doc_id = 8").first().text.encode())
    assert len({r.shard for r in rows if r.text_crc32 == crc}) == 1
    assert sharding.shard(empty, 5).collect() == []


def test_a_hot_group_does_not_empty_the_other_shards(spark):
    rows = [(i, "same text of many rows " * 4) for i in range(400)] + [(1000 + i, f"text {i} " * (1 + i % 9)) for i in range(800)]
    placed = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 8).collect()
    check_shards(placed, rows, 8)
    loads = Counter()
    for r in placed:
        loads[r.shard] += r.size
    rest = sorted(loads.values())[:-1]
    assert len(loads) == 8 and max(rest) < 1.1 * min(rest)


# ---------- mixing ----------

def test_mix_of_messy_rows_equals_sql(messy, empty):
    plain = messy.select("doc_id", "text", "source")
    same(mixing.mix(messy), duck_of(plain, "documents"), oracles.OP6)
    assert mixing.mix(empty).collect() == [] and mixing.mixed(empty).collect() == []


def test_mixed_rows_are_those_that_mix_counts(messy):
    taken = Counter()
    for r in mixing.mix(messy).collect():
        if r.size:
            taken[(r.doc_id, r.size)] += r.taken // r.size
    got = mixing.mixed(messy)
    assert got.columns == messy.columns
    words = Counter((r.doc_id, len((r.text or "").encode().split())) for r in got.collect())
    assert {k: v for k, v in words.items() if k[1]} == {k: v for k, v in taken.items() if v}


def test_budgets_are_nested_and_near(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 17)), "hot" if i % 3 else f"s{i % 7}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = mixing._sizes(df, "doc_id", "text", "source").select("source", "size", "h").cache()
    smaller = None
    for budget in (100.0, 1000.0, 5000.0):
        budgets = sizes.select("source").distinct().selectExpr("source", f"{budget}D as left")
        cut = {r.source: r.threshold for r in mixing.hash_thresholds(sizes, budgets).collect()}
        took = Counter()
        for r in sizes.collect():
            if r.h < cut.get(r.source, 1 << 62):
                took[r.source] += r["size"]
        whole = {r.source: r.t for r in sizes.groupBy("source").agg({"size": "sum"}).withColumnRenamed("sum(size)", "t").collect()}
        assert all(abs(took[s] - min(budget, whole[s])) <= 17 for s in whole)
        assert smaller is None or all(cut.get(s, 1 << 62) >= smaller.get(s, 1 << 62) for s in whole)
        smaller = cut


# ---------- line dedup ----------

def test_lines_on_too_many_pages_of_a_host_go(spark):
    page = "<html><nav>Home</nav><script>var x = '<p>';</script><p>{}</p><div>Footer &amp; more</div></html>"
    rows = [(i, f"https://Site.example.com/{i}?q=1", page.format(f"unique {i}"), 1) for i in range(20)]
    rows += [(100 + i, f"http://other.example.org:80/{i}", f"<p>Home</p><p>own {i}</p><p>own {i}</p>", 1) for i in range(2)]
    rows += [(200, None, "<p>Home</p>", 1), (201, "no host", None, 1), (None, "//x@user.example/", "", 1), (1, None, None, 1)]
    rows += [(202, "http://other.example.org/x", "<p>" + "word " * 50_000 + "</p><!-- " + "c" * 50_000 + " -->", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, lines int")
    got = line_dedup.drop_boilerplate(df, 0.5, 3)
    found = defaultdict(list)
    for r in got.collect():
        found[r.page_id].append(r)
    assert sum(map(len, found.values())) == len(rows)
    assert found[3][0].text == "unique 3" and found[3][0].n_dropped == 2 and found[3][0].host == "site.example.com"
    assert found[100][0].text == "Home\nown 0\nown 0" and found[100][0].host_pages == 3
    assert found[201][0].text == "" and found[200][0].text == "Home" and found[200][0].host == ""
    assert line_dedup.drop_boilerplate(df.limit(0)).collect() == []


# ---------- quality rules ----------

def test_rules_on_messy_rows_equal_sql(messy, empty):
    plain = messy.select("doc_id", "text")
    got = quality_rules.judge(messy).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines",
        "n_stop_words", "n_letters", "broken_rules")
    same(got, duck_of(plain, "documents"), oracles.OP10)
    assert quality_rules.judge(empty).collect() == []


def test_windows_of_a_long_text_keep_their_whole_hash(spark, monkeypatch):
    """Two windows whose hashes have the same 43 low bits, in 1.1 million words; then windows that all have one hash."""
    one, two = ([f"{x}{i}" for x in "abc"] for i in (174210, 379122))
    text = " ".join([*one, *map(str, range(1_100_000)), *two])
    assert quality_rules.judge(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().n_repeat_words == 0
    monkeypatch.setattr(quality_rules, "WINDOW_HASH", "0L")
    rows = spark.createDataFrame([(1, "a b c d a b c"), (2, "a b c d e f g")], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_repeat_words) for r in quality_rules.judge(rows).collect()) == [(1, 6), (2, 0)]


def test_rules_are_a_table(spark):
    df = spark.createDataFrame([(1, "the cat sat on the mat " * 2 + " ".join("word" + "abcdefghij"[i % 10] * (i // 10 + 1) for i in range(60)))], "doc_id long, text string")
    assert quality_rules.judge(df).first().kept
    strict = (quality_rules.Rule("n_words", least=1000), quality_rules.Rule("mean_word_chars", most=1))
    row = quality_rules.judge(df, strict).first()
    assert not row.kept and row.broken_rules == "n_words,mean_word_chars"


def test_no_python_in_native_plans(workers, messy):
    for df in (sharding.shard(messy, 5), mixing.mix(messy), quality_rules.judge(messy)):
        assert "Python" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert EXTRA
