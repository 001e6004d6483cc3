"""Sharding, mixing, decontamination and the pipeline against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from roadmill.llm import containment, exact_shards, mixture, token_blocks, weak_quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], SCHEMA)


# ---------------------------------------------------------------- shards


@given(st.lists(st.integers(0, 50), min_size=1, max_size=8), st.integers(1, 6), st.integers(0, 99))
def test_matrix_has_exact_sums(blocks, n, seed):
    total = sum(blocks)
    shards = [total // n + (j < total % n) for j in range(n)]
    m = exact_shards.communication_matrix(blocks, shards, seed)
    assert m.sum(axis=1).tolist() == blocks and m.sum(axis=0).tolist() == shards and (m >= 0).all()


def test_large_populations_have_the_right_moments():
    rng = np.random.default_rng(1)
    good, bad, draws = 3 * 10**9, 7 * 10**9, 10**6
    x = np.array([exact_shards.hypergeometric(rng, good, bad, draws) for _ in range(400)])
    sd = (draws * 0.3 * 0.7) ** 0.5
    assert abs(x.mean() - 3e5) < 5 * sd / 20 and 0.85 < x.std() / sd < 1.15


@pytest.mark.parametrize("n,slot_rows", [(24, 50_000), (5, 3), (24, 1)])
def test_shards_are_exact(spark, n, slot_rows):
    rng = random.Random(n)
    rows = [(i, rng.choice(["same text", None, "", "é" * rng.randrange(9)]), "s") for i in range(333)] + [(None, "a", "s"), (None, "a", "s"), (7, "b", "s")]
    got = exact_shards.shard_documents(frame(spark, rows).repartition(6), n, slot_rows=slot_rows).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    sizes = [len(by[j]) for j in range(n)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())


def test_the_shuffle_is_uniform_enough(spark):
    rows = [(i, "t", "s") for i in range(4000)]
    got = exact_shards.shard_documents(frame(spark, rows).repartitionByRange(8, "doc_id"), 4).collect()
    low = Counter(r.shard for r in got if r.doc_id < 500)
    assert all(85 < low[j] < 165 for j in range(4))
    place = np.corrcoef([r.doc_id for r in got], [r.slot for r in got])[0, 1]
    assert abs(place) < 0.06


def test_no_rows_to_shard(spark):
    assert exact_shards.shard_documents(frame(spark, [])).count() == 0


# ---------------------------------------------------------------- mixing


def plan_brute(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Shares by weight, stops and reshares until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, held = share * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in held]
        rest = total - sum(most * sizes[s] for s in held)
        target = {s: most * sizes[s] if s in held else rest * w[s] / sum(w[x] for x in free) for s in order}
        over = {s for s in free if target[s] > most * sizes[s] + 1e-9}
        if not over:
            return target
        held |= over


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@settings(max_examples=8, deadline=None)
@given(st.dictionaries(st.sampled_from(["a", "b", "B", "é", "zz", "", None, "k", "m"]), st.integers(1, 400), min_size=1))
def test_targets_equal_resharing(spark, sizes):
    df = spark.createDataFrame([("n" if s is None else "s" + s, n) for s, n in sizes.items()], "src string, source_size long")
    got = {r.src: r.target for r in mixture.targets(df).collect()}
    for s, t in plan_brute(sizes).items():
        assert got["n" if s is None else "s" + s] == pytest.approx(t, rel=1e-9)


def test_mix_equals_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, " ".join("w" * rng.randrange(0, 30)), rng.choice(["hot"] * 6 + ["b", "c", None, ""])) for i in range(700)] + [(9000, None, "b"), (9001, "", "c"), (9002, "x\ty\n", None), (9003, "w " * 9000, "hot"), (9004, "r", "b"), (9004, "r", "b"), (None, "n n", "c")]
    got = mixture.mix(frame(spark, rows)).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += n_words(t)
    target = plan_brute(sizes)
    own = {(i, t): s for i, t, s in rows}
    taken, most = Counter(), Counter()
    by_id = defaultdict(list)
    for i, t, s in rows:
        by_id[i].append((t, s))
    assert sorted(r.size for r in got) == sorted(n_words(t) for _, t, _ in rows)
    for r in got:
        s = next(s for t, s in by_id[r.doc_id] if n_words(t) == r.size)
        assert r.source_size == sizes[s] and r.target == pytest.approx(target[s])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[s] += r.taken
        most[s] = max(most[s], r.size)
    for s, t in target.items():
        # a source of one hot long document misses by up to half of it, others by half of a usual document
        assert abs(taken[s] - t) <= most[s] / 2 + 1e-6, (s, t, taken[s])
        assert most[s] > 1000 or abs(taken[s] - t) <= 0.02 * t, (s, t, taken[s])
    assert own and sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixture.mix(frame(spark, rows[::-1]).repartition(5)).collect()), key=repr), "reruns agree"


def test_take_repeats_rows_as_mixed(spark):
    rows = [(i, "a b c", "x" if i % 5 else "y") for i in range(200)]
    docs = frame(spark, rows).withColumnsRenamed({"lang": "whole", "n_chars": "cut"})
    times = {r.doc_id: r.times for r in mixture.mix(docs).collect()}
    got = mixture.take(docs)
    assert got.columns == docs.columns
    assert Counter(r.doc_id for r in got.collect()) == Counter({i: n for i, n in times.items() if n})


def test_nothing_to_mix(spark):
    assert mixture.mix(frame(spark, [])).count() == 0
    assert [r.taken for r in mixture.mix(frame(spark, [(1, None, None), (2, "", "a")])).collect()] == [0, 0]


# ---------------------------------------------------------------- decontamination


def shingles(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def test_contaminated_equals_brute_force(spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(40)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, text(rng.choice([3, 5, 6, 9, 14, 30, 55, 130]))) for k in range(40)] + [(100, None), (101, ""), (102, "W1 w2\tW3"), (103, "dup " * 12), (103, "dup " * 12)]
    rows = []
    for k in range(150):
        t = text(rng.randrange(0, 80)).split()
        if k % 3 == 0:
            piece = items[k % 40][1].split()
            for _ in range(rng.randrange(0, 4)):
                if len(piece) > 20:
                    piece[rng.randrange(len(piece))] = "changed"
            at = rng.randrange(len(t) + 1)
            t[at:at] = piece
        rows.append((k, " ".join(t), "s"))
    rows += [(500, None, "s"), (501, "", "s"), (502, "w1 W2 w3", "s"), (503, text(20_000) + " " + items[5][1], "s"), (None, items[7][1], "s"), (7, rows[7][1], "s"), (504, "dup " * 40, "s")]
    docs, bench = frame(spark, rows), spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, k1 int")
    expected = Counter()
    for i, t, _ in rows:
        have = shingles(t)
        for k, u in items:
            want = shingles(u)
            if want and 100 * len(have & want) >= 80 * len(want):
                expected[i, k, len(have & want), len(want)] += 1
    got = containment.contaminated(docs, bench).collect()
    assert {(r.doc_id, r.item_id, r.n_shared, r.n_shingles) for r in got} == set(expected)
    assert sum(expected.values()) > 20
    bad = {(i, t) for i, t, _ in rows if any(shingles(u) and 100 * len(shingles(t) & shingles(u)) >= 80 * len(shingles(u)) for _, u in items)}
    clean = containment.clean(docs, bench)
    assert clean.columns == docs.columns
    assert Counter(r.doc_id for r in clean.collect()) == Counter(i for i, t, _ in rows if (i, t) not in bad)


def test_a_common_shingle_alone_makes_no_candidate(spark):
    """Items of many shingles need several hashes of their sketch; the numbers never lose an item that is contained."""
    text = lambda k, n: " ".join(f"{k}x{j}" for j in range(n))
    items = spark.createDataFrame([(n, text("i", n)) for n in range(5, 200)], "item_id long, text string")
    by_item = {}
    for r in containment.item_sketches(items).collect():
        by_item.setdefault((r.n, r.need, r.partition), set()).add(r.hash)
    assert len(by_item) == 195
    for (n, need, partition), sketch in by_item.items():
        assert 2 ** (partition - 1) < n <= 2**partition
        assert need == len(sketch) - n * 20 // 100 >= 1, "what may be missing leaves as many as are needed"
        assert n < 60 or need > 5


def test_items_that_share_an_id_are_items_of_their_own(spark):
    items = spark.createDataFrame([(1, "a b c d e f"), (1, "k l m n o p"), (None, "q r s t u v")], "item_id long, text string")
    docs = frame(spark, [(1, "x a b c d e f", "s"), (2, "k l m n o p y", "s"), (3, "z q r s t u v", "s"), (4, "a b c x k l m", "s")])
    assert sorted((r.doc_id, r.item_id or 0) for r in containment.contaminated(docs, items).collect()) == [(1, 1), (2, 1), (3, 0)]


def test_nothing_to_decontaminate(spark):
    none, bench = frame(spark, []), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert containment.contaminated(none, bench).count() == 0
    some = frame(spark, [(1, "a b c d e f", "s")])
    assert containment.contaminated(some, bench.where("item_id < 0")).count() == 0
    assert containment.clean(some, bench.where("item_id < 0")).count() == 1


def test_plans_are_native(spark):
    docs, bench = frame(spark, [(1, "a b c d e f", "s")]), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    for df in (mixture.mix(docs), mixture.take(docs), containment.clean(docs, bench)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


# ---------------------------------------------------------------- pipeline


def test_stages_keep_the_columns_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns


def test_run_equals_brute_force(spark, sf_dir):
    """Each stage's decisions, made again by plain loops over the rows that reach it."""
    from test_dedup import near_brute
    from test_tokens import brute, plain_ids

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    rows = [tuple(r) for r in docs.collect()]
    at = {c: k for k, c in enumerate(columns)}
    model = weak_quality.fit(docs.select("doc_id", "text"))
    rows = [r for r in rows if model.scorer.score((r[at["text"]] or "").split()) >= 0.5]
    kept = {r[0] for r in near_brute([(r[at["doc_id"]], r[at["text"]]) for r in rows], 5) if r[3]}
    rows = [r for r in rows if r[at["doc_id"]] in kept]
    items = [shingles(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rows = [r for r in rows if not any(w and 100 * len(shingles(r[at["text"]]) & w) >= 80 * len(w) for w in items)]
    times = {r.doc_id: r.times for r in mixture.mix(spark.createDataFrame(rows, docs.schema)).collect()}
    rows = [r for r in rows for _ in range(times[r[at["doc_id"]]])]
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == brute([(r[at["doc_id"]], r[at["text"]]) for r in rows])
    # the corpus's ids are read again from the files that stay
    kept = token_blocks.read_blocks(spark, corpus_pipeline.token_folder(spark, sf_dir)).orderBy("part", "seq").collect()
    blocks = [token_blocks.open_block(r.payload) for r in kept]
    ids = [(b.doc_id(k), b.tokens(k).tolist()) for b in blocks for k in range(b.n_docs)]
    ordered = sorted((r[at["doc_id"]], r[at["text"]]) for r in rows)
    assert ids == [(i, [*x, 1]) for (i, _), x in zip(ordered, plain_ids([t or "" for _, t in ordered]), strict=True)]
    assert len(rows) > 100


def test_near_duplicate_stage_with_repeated_and_null_ids(spark, sf_dir):
    a, b, c = ("one two three four five six seven eight nine ten " + x for x in ("alpha beta", "gamma delta", "epsilon zeta eta theta iota kappa"))
    rows = [(3, b, "s"), (5, a, "s"), (5, b + " tail", "t"), (None, b, "s"), (8, None, "s"), (8, None, "s"), (9, "", None), (10, c, "s"), (10, c, "t")]
    got = corpus_pipeline.near_duplicates(spark, frame(spark, rows), sf_dir)
    assert got.columns == frame(spark, []).columns
    found = sorted(((r.doc_id, r.text) for r in got.collect()), key=repr)
    assert found == sorted([(3, b), (5, a), (8, None), (8, None), (9, ""), (10, c)], key=repr)
    assert corpus_pipeline.near_duplicates(spark, frame(spark, []), sf_dir).count() == 0
