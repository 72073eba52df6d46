"""Operators on texts against brute force: near-dedup, decontamination, languages, tokens, language model."""
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import edited, prose
from tidemark.llm import (components, decontamination, language_id, near_dedup, pitman_yor, token_counts, token_file)
from tidemark.llm.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def rows_of(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


# ---------- near-duplicates ----------

def shingle_set(text, k):
    words = (text or "").encode().lower().split()
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}


def brute_components(rows, k, percent=80):
    """Smallest id reachable for each row; nulls never name a component of others."""
    sets = [shingle_set(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                common = len(sets[i] & sets[j])
                if 100 * common >= percent * len(sets[i] | sets[j]):
                    parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)].append(doc_id)
    return Counter((doc_id, len(sets[i]), min(least[find(i)]) if sets[i] and least[find(i)] else doc_id)
                   for i, (doc_id, _) in enumerate(rows))


@pytest.mark.parametrize("k", [2, 5])
def test_groups_of_messy_rows(messy, empty, k):
    got = Counter(rows_of(near_dedup.near_duplicates(messy, k=k), "doc_id", "n_shingles", "component_id"))
    assert got == brute_components(rows_of(messy, "doc_id", "text"), k)
    assert near_dedup.near_duplicates(empty, k=k).collect() == []


def test_large_groups_with_stragglers(workers):
    """More near copies than a bucket pairs completely, chains through them, and many texts sharing a passage."""
    base, passage = prose(11, 200), prose(12, 60)
    rows = [(i, edited(base, i, i % 5)) for i in range(120)]
    chain = base
    for i in range(12):
        chain = edited(chain, 1000 + i, 4)
        rows.append((200 + i, chain))
    rows += [(300 + i, passage + " " + prose(5000 + i, 14)) for i in range(60)]
    rows += [(400 + i, prose(9000 + i, 50)) for i in range(30)]
    df = workers.createDataFrame(rows, "doc_id long, text string")
    for k in (2, 5):
        got = Counter(rows_of(near_dedup.near_duplicates(df, k=k), "doc_id", "n_shingles", "component_id"))
        assert got == brute_components(rows, k)


def test_overfull_buckets_lose_no_link(workers, monkeypatch):
    monkeypatch.setattr(near_dedup, "COMPLETE", 2)
    monkeypatch.setattr(near_dedup, "CHAIN", 1)
    rng = random.Random(3)
    rows = []
    for g in range(3):
        base = prose(40 + g, 90)
        rows += [(100 * g + i, edited(base, 100 * g + i, rng.choice([3, 6, 8]))) for i in range(30)]
    df = workers.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    got = Counter(rows_of(near_dedup.near_duplicates(df, k=2), "doc_id", "n_shingles", "component_id"))
    assert got == brute_components(rows, 2)


def test_components_of_chains_and_stars(workers):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(5, 5), (200, 199), (41, 100)]
    got = dict(rows_of(components.components(workers.createDataFrame(links, "a long, b long")), "node", "root"))
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 41 for i in range(30)}, 41: 41, 199: 199, 200: 199}
    assert components.components(workers.createDataFrame([], "a long, b long")).collect() == []


# ---------- decontamination ----------

def plain_words(text):
    return re.findall(rb"[a-z0-9\x80-\xff]+", (text or "").encode().lower())


def weighted_shingles(words, k=5):
    k = min(k, len(words))
    out = Counter()
    for i in range(len(words) - k + 1):
        out[tuple(words[i:i + k])] += sum(map(len, words[i:i + k]))
    return out


def brute_passages(docs, items, least=0.8):
    found = {}
    for item, item_text in items:
        own = plain_words(item_text)
        goal = weighted_shingles(own)
        for doc, text in docs:
            words = plain_words(text)
            for s in range(max(1, len(words) - len(own) + 1)) if own and words else ():
                window = weighted_shingles(words[s:s + len(own)])
                common = sum((goal & window).values())
                score = common / (sum(goal.values()) + sum(window.values()) - common)
                if score >= least and score > found.get((doc, item), (0, 0))[0]:
                    found[(doc, item)] = (score, s)
    return {k: (round(v[0], 6), v[1]) for k, v in found.items()}


def test_passages_are_found_at_their_place(workers, messy, empty):
    items = [(i, prose(70 + i, 12 + 3 * i)) for i in range(12)] + [(50, "rare tiny item"), (51, None), (52, ""), (53, "...")]
    docs = [(i, prose(80 + i, 90) + " " + (t or "").upper().replace(" ", ", ") + ". " + prose(120 + i, 50))
            for i, (_, t) in enumerate(items)]
    docs += [(100, edited(items[9][1], 1, 1)), (101, edited(items[11][1], 2, 1) + " tail"), (102, items[5][1][:40]),
             (103, None), (104, "RARE tiny-item"), (105, "long " * 5000 + items[3][1] + " " + items[4][1] + " " + items[3][1])]
    frame = workers.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, item_id int")
    wanted = workers.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    got = {(r.doc_id, r.item_id): (r.similarity, r.first_word) for r in decontamination.find_passages(frame, wanted).collect()}
    assert got == brute_passages(docs, items)
    clean = decontamination.without_passages(frame, wanted)
    assert clean.columns == frame.columns
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in docs} - {d for d, _ in got}
    assert decontamination.find_passages(empty, wanted).collect() == []
    assert decontamination.find_passages(frame, wanted.limit(0)).collect() == []
    assert decontamination.without_passages(messy, wanted).count() == messy.count()


def test_items_in_several_blocks_give_the_same(workers):
    docs, items = workers.read.parquet(f"{FOLDER}/documents.parquet"), workers.read.parquet(f"{FOLDER}/benchmark.parquet")
    whole = decontamination.find_passages(docs, items).collect()
    original = decontamination.item_blocks
    decontamination.item_blocks = lambda *a: original(*a, block_words=300)
    try:
        assert sorted(decontamination.find_passages(docs, items).collect()) == sorted(whole)
    finally:
        decontamination.item_blocks = original
    expected = brute_passages(rows_of(docs, "doc_id", "text"), rows_of(items, "item_id", "text"))
    assert {(r.doc_id, r.item_id): (r.similarity, r.first_word) for r in whole} == expected


def test_index_finds_every_fingerprint_in_the_radius():
    index = decontamination.Index([1, 2, 3], [prose(i, 20) for i in (1, 2, 3)])
    rng = random.Random(5)
    for item in range(3):
        for _ in range(300):
            flips = rng.sample(range(64), rng.randint(0, decontamination.RADIUS))
            near = np.array([int(index.prints[item]) ^ sum(1 << b for b in flips)], dtype=np.uint64)
            assert item in index.near(near, 20)[1]


def test_barely_similar_windows_are_candidates():
    """Items against copies with replaced words, at similarities between 0.80 and 0.85: all are found."""
    rng, pairs = random.Random(9), []
    while len(pairs) < 1500:
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(49, 200))]
        other = list(words)
        for i in rng.sample(range(len(words)), max(1, len(words) // rng.choice([50, 70]))):
            other[i] = f"x{rng.randrange(10**6)}"
        x, y = (weighted_shingles([w.encode() for w in v]) for v in (words, other))
        if 0.8 <= (common := sum((x & y).values())) / (sum(x.values()) + sum(y.values()) - common) <= 0.85:
            pairs.append((" ".join(words), " ".join(other)))
    index = decontamination.Index(list(range(len(pairs))), [x for x, _ in pairs])
    found = {(t, i) for at, _, words in decontamination.blocks(decontamination.pa.array([y for _, y in pairs]), plain=True)
             for t, i, *_ in ((at + t, *rest) for t, *rest in index.hits(words, 0.8))}
    assert found >= {(i, i) for i in range(len(pairs))}


# ---------- languages ----------

def test_languages_of_test_data(workers):
    got = {r.doc_id: r for r in QUERIES["op4_language_id"](workers, FOLDER).collect()}
    docs = rows_of(workers.read.parquet(f"{FOLDER}/documents.parquet"), "doc_id", "lang", "text")
    assert len(got) == len(docs)
    held = [(lang, got[i].lang_pred) for i, lang, _ in docs if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in docs)
    assert sum(a == b for a, b in held) >= 0.95 * len(held)


def test_languages_of_messy_rows(messy, empty):
    rows = language_id.predict_languages(messy).collect()
    assert len(rows) == messy.count() and all(0 <= r.score <= 1 for r in rows)
    letterless = Counter(i for i, t in rows_of(messy, "doc_id", "text") if not any(c.isalpha() for c in t or ""))
    assert Counter(r.doc_id for r in rows if r.lang_pred == "und") == letterless
    assert language_id.predict_languages(empty).collect() == []
    unlabelled = messy.drop("lang").selectExpr("*", "cast(null as string) as lang")
    assert {(r.lang_pred, r.score) for r in language_id.predict_languages(unlabelled).collect()} == {("und", 0.0)}
    kept = language_id.recognised(messy, language_id.learn(messy), 0.0)
    assert kept.columns == messy.columns and kept.count() == messy.count() - sum(letterless.values())


def test_short_clean_texts_are_not_rejected(workers):
    from corpus_pipeline import LEAST_COSINE
    docs = workers.read.parquet(f"{FOLDER}/documents.parquet")
    words = sorted({w for (t,) in rows_of(docs, "text") for w in re.findall(r"[^\W\d_]+", t or "")})
    singles = workers.createDataFrame([(i, w) for i, w in enumerate(words)], "doc_id long, text string")
    assert language_id.recognised(singles, language_id.learn(docs), LEAST_COSINE).count() == len(words)
    nothing = language_id.Guesser([], np.zeros((0, language_id.DIMENSIONS)))
    some = workers.createDataFrame([(1, "some words"), (2, "12 !"), (3, None)], "doc_id long, text string")
    assert rows_of(language_id.recognised(some, nothing, LEAST_COSINE), "doc_id") == [(1,)]


def test_profiles_are_bound_and_bundled_letters():
    text = "Ab ab"
    roll = np.roll
    v = {c: language_id.letter_vector(ord(c) if c != " " else 0).astype(int) for c in "ab "}
    grams = [" ab", "ab ", "b a", " ab", "ab "]
    by_hand = sum(roll(v[g[0]], 2) * roll(v[g[1]], 1) * v[g[2]] for g in grams)
    block = language_id.Block([text])
    assert (sum(c @ x for c, x in block.parts())[0] == by_hand).all()


# ---------- token counts and token file ----------

@pytest.fixture(scope="module")
def encoded(messy):
    plain = Tokenizer.from_file(TOKENIZER)
    return [(i, t, plain.encode(t or "", add_special_tokens=False).ids) for i, t in rows_of(messy, "doc_id", "text")]


@pytest.mark.parametrize("most", [0, 5, 262_144])
def test_token_counts(messy, encoded, most):
    got = token_counts.count_tokens(messy, TOKENIZER, 100, frequent_words=most)
    assert Counter(rows_of(got, "doc_id", "n_bytes", "n_tokens", "over_limit")) == Counter(
        (i, len((t or "").encode()), len(ids), len(ids) > 100) for i, t, ids in encoded)


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "int", "long", "string", "decimal(5, 0)"])
def test_passages_keep_the_type_of_their_ids(workers, kind):
    text = " ".join(f"word{i}" for i in range(30))
    items = workers.createDataFrame([("7", text)], "item_id string, text string").selectExpr(f"cast(item_id as {kind}) as item_id", "text")
    docs = items.selectExpr("item_id as doc_id", "concat('before ', text, ' after') as text")
    found = decontamination.find_passages(docs, items)
    assert dict(found.dtypes)["item_id"] == dict(items.dtypes)["item_id"] and str(found.first().item_id) == str(items.first().item_id)


def test_token_counts_of_nothing(empty):
    assert token_counts.count_tokens(empty, TOKENIZER).collect() == []


@pytest.mark.parametrize("per_file", [16_000_000, 5_000])
def test_token_file_round_trip(workers, messy, encoded, tmp_path, monkeypatch, per_file):
    monkeypatch.setattr(token_file, "IDS_PER_FILE", per_file)
    folder = str(tmp_path / "ids")
    token_file.write_ids(messy, TOKENIZER, folder)
    back = token_file.read_documents(workers, folder, lambda ids: ids.tolist(), "array<long>").orderBy("start").collect()
    assert [r.doc_id is not None for r in back] == sorted(r.doc_id is not None for r in back)
    ids = [r.doc_id for r in back if r.doc_id is not None]
    assert ids == sorted(ids)
    assert [r.start for r in back] == np.cumsum([0] + [r.n_tokens for r in back])[:-1].tolist()
    assert Counter((r.doc_id, tuple(r.value)) for r in back) == Counter((i, (*x, 2)) for i, _, x in encoded)


def test_token_file_of_nothing(workers, empty, tmp_path):
    assert token_file.stored_digests(empty, TOKENIZER, str(tmp_path / "ids")).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=40))
def test_ranks_round_trip(ranks):
    control, data = token_file.encode(np.array(ranks, dtype=np.uint32))
    assert len(control) == -(-len(ranks) // 4)
    assert len(data) == sum(max(1, -(-r.bit_length() // 8)) for r in ranks)
    assert token_file.decode(control, data, len(ranks)).tolist() == ranks


# ---------- language model ----------

def test_base_scores_of_messy_rows_are_exact(messy, empty, monkeypatch):
    texts = rows_of(messy, "doc_id", "text")
    tokens = [(i, (t or "").encode().lower().split() + [None]) for i, t in texts]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in texts]
    count = Counter(w for (_, x), h in zip(tokens, held) if not h for w in x)
    total, distinct = sum(count.values()), len(count)
    expected = sorted((-1 if i is None else i, h, len(x), sum(count[w] > 0 for w in x), total,
                       sum(math.log10((count[w] + .5) / (total + .5 * (distinct + 1))) for w in x))
                      for (i, x), h in zip(tokens, held))
    results = []
    for most, pairs in ((32_768, 16_000_000), (32_768, 900), (20, 16_000_000), (0, 1)):
        monkeypatch.setattr(pitman_yor, "MOST_PAIRS", pairs)
        got = sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
                     for r in pitman_yor.score_texts(messy, frequent_words=most).collect())
        assert [g[:5] for g in got] == [e[:5] for e in expected]
        assert all(abs(g[5] - e[5]) < 1e-6 * abs(e[5]) for g, e in zip(got, expected))
        results.append([g[6] for g in got])
    assert all(abs(x - y) < 1e-5 * abs(x) for other in results[1:] for x, y in zip(results[0], other))
    assert pitman_yor.score_texts(empty).collect() == []


def test_nothing_to_learn_from(workers):
    ids = [i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1]
    rows = pitman_yor.score_texts(workers.createDataFrame([(i, "some words") for i in ids], "doc_id long, text string")).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and abs(r.score) < 1e-6 for r in rows)


def test_model_beats_base_on_held_out_texts(workers):
    rows = QUERIES["op1_pitman_yor"](workers, FOLDER).where("held_out").collect()
    assert sum(r.score for r in rows) > 0.95 * sum(r.base_score for r in rows)


def test_contexts_are_whole_words_before(workers):
    """What follows 'nation', 'station' and two words is told apart, though their last three bytes are equal."""
    learned = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 != 1]
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 1][:6]
    pairs = ["nation alpha", "station beta", "red car stops", "old car starts"]
    rows = [(i, pairs[i % 4]) for i in learned] + list(zip(held, [
        "nation alpha", "nation beta", "station beta", "station alpha", "red car stops", "red car starts"]))
    got = {r.doc_id: r.score for r in pitman_yor.score_texts(workers.createDataFrame(rows, "doc_id long, text string")).collect()}
    for right, wrong in zip(held[::2], held[1::2]):
        assert got[right] > got[wrong] + 1


@pytest.mark.parametrize("sweeps, burn_in", [(1, 0), (3, 1)])
def test_probabilities_add_up_to_one(workers, sweeps, burn_in):
    """Over all words and the unknown one, in every restaurant, those without customers included."""
    rng = np.random.default_rng(4)
    contexts = [(100 + two, two % 5) for two in range(12)]
    counts = {(word, two): int(rng.integers(0, 60) ** 2 // 600) if word and two < 111 else 0
              for word in range(31) for two, _ in contexts}
    trained = {word: sum(counts[word, two] for two, _ in contexts) for word in range(31)}
    leaves = workers.createDataFrame(
        [(word, one, two, word % 3 == 0, one % 2 == 0, counts[word, two]) for word in range(31) for two, one in contexts],
        "word long, one long, two long, hot boolean, hot_one boolean, n long")
    words = workers.createDataFrame([(w, w % 3 == 0, n) for w, n in trained.items()], "word long, hot boolean, trained long")
    learned, distinct = sum(trained.values()), sum(n > 0 for n in trained.values())
    assert trained[0] == 0 and distinct == 30
    model = rows_of(pitman_yor.sampled(leaves, words, learned, distinct, sweeps, burn_in), "word", "two", "p")
    for two, _ in contexts:
        own = [p for _, t, p in model if t == two]
        assert len(own) == 31 and min(own) > 0 and abs(sum(own) - 1) < 1e-9


def test_tables_of_many_customers_follow_the_exact_ones():
    """Mean and deviation of the normal draw above ``EXACT`` customers, against exact draws of ``EXACT``."""
    from tidemark.llm import seating
    number = 4000
    seeds = np.random.default_rng(1).integers(0, 2**64, number, dtype=np.uint64)
    customers, parent = np.full(number, seating.EXACT), np.full(number, 0.05)
    for discount in (0.3, 0.8):
        for others in (500, 20_000, 200_000):
            given = customers, np.full(number, others), parent, 1.0
            exact = seating.draw(*given, seating.Stirling(discount), seeds, 1)
            near = seating.draw_near(*given, discount, seeds, 1)
            assert abs(near.mean() - exact.mean()) < 0.04 * exact.mean() and abs(near.std() - exact.std()) < 0.05 * exact.std()


def test_tables_are_drawn_from_their_conditional_probabilities():
    """Shares of each number of tables, against all ways to seat five customers counted one by one."""
    from tidemark.llm import seating
    strength, others, parent = 1.0, 7, 0.03
    for discount in (0.2, 0.5, 0.9):
        ways = {(1,): 1.0}                          # customers of each table, in the order of opening
        for _ in range(4):
            more = Counter()
            for tables, chance in ways.items():
                more[tables + (1,)] += chance
                for i, x in enumerate(tables):
                    more[tables[:i] + (x + 1,) + tables[i + 1:]] += chance * (x - discount)
            ways = more
        exact = Counter()
        for tables, chance in ways.items():
            exact[len(tables)] += chance * math.prod((strength + discount * (others + j)) * parent for j in range(len(tables)))
        number = 200_000
        seeds = np.random.default_rng(5).integers(0, 2**64, number, dtype=np.uint64)
        got = seating.draw(np.full(number, 5), np.full(number, others), np.full(number, parent), strength,
                           seating.Stirling(discount), seeds, 2)
        share = Counter(got.tolist())
        assert all(abs(share[t] / number - exact[t] / sum(exact.values())) < 0.005 for t in range(1, 6))


def test_perplexity_is_of_the_mean_token(workers):
    from tidemark.llm.pitman_yor import perplexity
    scored = workers.createDataFrame([(True, 4, -8.0, -4.0), (True, 6, -12.0, -6.0), (False, 5, -5.0, 0.0)],
                                     "held_out boolean, n_tokens long, base_score double, score double")
    got = {r.held_out: (r.n_tokens, round(r.base_perplexity, 6), round(r.perplexity, 6)) for r in perplexity(scored).collect()}
    assert got == {True: (10, 100.0, 10.0), False: (5, 10.0, 1.0)}
    assert perplexity(scored.where("false")).collect() == []


def test_scores_do_not_depend_on_blocks(workers, messy, monkeypatch):
    """One block, or many with pieces for the words that are too frequent for one; occurrences travel in a few bytes."""
    def scores() -> list[tuple]:
        return sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.base_score, r.score) for r in pitman_yor.score_texts(messy).collect())

    whole, known = scores(), []
    monkeypatch.setattr(pitman_yor, "BLOCK_TOKENS", 5000)
    begin = pitman_yor.Numbers.__init__
    monkeypatch.setattr(pitman_yor.Numbers, "__init__", lambda self, *x: known.append(self) or begin(self, *x))
    parted = scores()
    assert known[0].number > 1 and len(known[0].heavy) > 0 and max(known[0].pieces) > 1
    assert [x[:2] for x in whole] == [x[:2] for x in parted]
    assert all(abs(x - y) < 1e-6 for a, b in zip(whole, parted) for x, y in zip(a[2:], b[2:]))


def test_occurrences_travel_in_few_bytes(workers):
    """Every word after its two words before, with its text: below 12 bytes each (three hashes alone are 24)."""
    from pyspark.sql import functions as F
    docs = workers.read.parquet(f"{FOLDER}/documents.parquet").select("text", F.lit(False).alias("held_out"),
                                                                        F.monotonically_increasing_id().alias("row"))
    words = pitman_yor.count_words(docs).orderBy(F.desc("freq")).limit(4096).toPandas().word.to_numpy()
    numbers = workers.sparkContext.broadcast(pitman_yor.Numbers(words.view(np.uint64), 2))
    size = pitman_yor.gathered(docs, numbers).agg(F.sum(F.length("blob"))).first()[0]
    assert size < 12 * pitman_yor.count_words(docs).agg(F.sum("freq")).first()[0]
