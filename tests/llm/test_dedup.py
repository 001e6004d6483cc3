"""Exact dedup, near-duplicates and repeated units against brute force, with nulls, ties and repeated rows."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from roadmill.llm import block_naming, circulant, unit_dedup
from roadmill.llm.components import connected_components

SCHEMA = "doc_id long, text string, extra string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)


def words(rng, n):
    return " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()) + str(rng.randrange(60)) for _ in range(n))


# ---------------------------------------------------------------- exact


def exact_brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    out = []
    for (i, _), n in zip(rows, norm, strict=True):
        same = [j for (j, _), m in zip(rows, norm, strict=True) if m == n]
        keep = min((j for j in same if j is not None), default=None)
        out.append((i, keep, len(same), i == keep, hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_bytes", [3, 64, 4096])
def test_block_naming_equals_brute_force(spark, block_bytes):
    rng = random.Random(block_bytes)
    long = words(rng, 400)
    rows = [(5, "a b"), (2, "a  b"), (9, "a\tb"), (7, None), (8, ""), (3, " "), (4, "\n"), (11, long), (12, long.replace(" ", "\n")), (13, long + "x"), (14, long[:-1]), (None, "a b"), (None, "only"), (6, "é" * 5), (16, "é" * 5), (2, "a b")]
    rows += [(100 + i, "ab" * (i % 5)) for i in range(20)]
    got = [tuple(r) for r in block_naming.deduplicate(frame(spark, rows), block_bytes).collect()]
    assert sorted(got, key=repr) == exact_brute(rows)


def test_block_naming_of_blocks_that_share_their_hashes(spark, monkeypatch):
    real = block_naming._named_blocks

    def clash(texts, size):
        from pyspark.sql import functions as F

        return real(texts, size).withColumns({"h1": F.lit(1).cast("long"), "h2": F.lit(1).cast("long")})

    monkeypatch.setattr(block_naming, "_named_blocks", clash)
    rows = [(1, "one"), (2, "two"), (3, "one"), (4, "three and more")]
    assert sorted((tuple(r) for r in block_naming.deduplicate(frame(spark, rows), 4).collect()), key=repr) == exact_brute(rows)


def test_block_naming_of_no_rows(spark):
    assert block_naming.deduplicate(frame(spark, []), 8).count() == 0


# ---------------------------------------------------------------- near


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def near_brute(rows, n):
    sets = [shingles(t, n) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                up[top(a)] = top(b)
    out = []
    for k, (i, _) in enumerate(rows):
        if sets[k]:
            named = [rows[j][0] for j in range(len(rows)) if top(j) == top(k) and rows[j][0] is not None]
            least = min(named, default=None)
        else:
            least = i
        out.append((i, len(sets[k]), least, i == least))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size,small,pivots,chunk", [(4, 8, 64, 128), (5, 2, 1, 3), (4, 3, 2, 2)])
def test_circulant_minhash_equals_brute_force(spark, size, small, pivots, chunk):
    rng = random.Random(size * 10 + small)
    rows = [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "ONE  two"), (905, "one two three"), (None, "null id text of some words here"), (906, "Null ID text of some words here"), (None, "alone among all the nulls here")]
    number = 0
    for _ in range(12):
        base = words(rng, rng.randrange(20, 120)).split()
        for _ in range(rng.randrange(1, 14)):
            text = list(base)
            for _ in range(rng.randrange(0, 5)):
                text[rng.randrange(len(text))] = words(rng, 1)
            rows.append((number, " ".join(text)))
            number += 1
    rows += [(3, rows[12][1]), (950, words(rng, 8000))]
    got = [tuple(r) for r in circulant.near_duplicates(frame(spark, rows), size, 80, small=small, pivots=pivots, chunk=chunk).collect()]
    assert sorted(got, key=repr) == near_brute(rows, size)


def test_a_chain_longer_than_a_bucket_is_one_component(spark):
    base = [f"w{i}" for i in range(100)]
    rows = [(k, " ".join(f"v{i}" if i < 3 * k else w for i, w in enumerate(base))) for k in range(25)]
    got = {r.doc_id: r.component_id for r in circulant.near_duplicates(frame(spark, rows), 4, 80, small=2, pivots=2).collect()}
    assert got == {r[0]: r[2] for r in near_brute(rows, 4)}
    assert len(set(got.values())) < 25


def test_near_duplicates_of_no_rows(spark):
    assert circulant.near_duplicates(frame(spark, []), 5).count() == 0
    assert circulant.keep_one(frame(spark, []), 5).count() == 0


def keep_brute(rows, n):
    """One row of each component, by loops: the least id (null last), any text of it; wordless rows all stay."""
    sets = [shingles(t, n) for _, t in rows]
    near = lambda a, b: bool(sets[a]) and bool(sets[b]) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    left, out = set(range(len(rows))), []
    while left:
        part, todo = set(), [min(left)]
        while todo:
            k = todo.pop()
            part.add(k)
            todo += [j for j in left - part if near(k, j) and j not in todo]
        left -= part
        if sets[min(part)]:
            out.append({rows[k] for k in part if (rows[k][0] is None, rows[k][0] or 0) == min((rows[j][0] is None, rows[j][0] or 0) for j in part)})
        else:
            out.append({rows[k] for k in part})
    return out


def test_one_row_of_each_component_stays_whatever_the_ids(spark):
    rng = random.Random(7)
    a, b, c = words(rng, 40), words(rng, 40), words(rng, 40)
    rows = [(3, b), (5, a), (5, b + " tail"), (None, b), (6, a), (6, a), (None, c), (None, c), (7, None), (7, None), (8, ""), (None, " "), (9, words(rng, 9000)), (5, a)]
    docs = spark.createDataFrame([(i, t, k % 3, "x") for k, (i, t) in enumerate(rows)], "doc_id long, text string, k1 int, n string")
    got = circulant.keep_one(docs)
    assert got.columns == docs.columns
    found = [(r.doc_id, r.text) for r in got.collect()]
    expected = keep_brute(rows, 5)
    assert len(found) == len(expected)
    for choice in expected:
        assert sum(x in choice for x in found) >= 1, choice
    assert sorted(found, key=repr) == sorted(((r.doc_id, r.text) for r in circulant.keep_one(docs.repartition(3)).collect()), key=repr)


def test_long_texts_share_no_band_by_chance():
    """Sets of 10**6 shingles that have none in common, in a universe of 2**32."""
    rng = np.random.default_rng(4)
    s = circulant.Signer(5, 128, 8)
    bands = [set(enumerate(s.bands(np.unique(rng.integers(0, 1 << 63, 10**6).astype(np.uint64) * np.uint64(2)), 4).tolist())) for _ in range(3)]
    assert not bands[0] & bands[1] and not bands[1] & bands[2]


def test_signature_estimates_jaccard():
    s = circulant.Signer(1, 256, 3)
    a, b = s.shingles(" ".join(f"a{i}" for i in range(300))), s.shingles(" ".join(f"a{i}" for i in range(100, 400)))
    same = (s.signature(a) == s.signature(b)).mean()
    assert abs(same - 0.5) < 0.12


@pytest.mark.parametrize("seed", range(3))
def test_connected_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(i, i + 1) for i in range(100, 140)]
    up = {}

    def top(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for u, v in links:
        a, b = sorted((top(u), top(v)))
        up[b] = a
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {n: top(n) for n in up}


# ---------------------------------------------------------------- repeated units


def plain_units(text):
    """(line of one sentence or more, start, end, words) of lines, and the same of sentences, by walking characters."""
    lines, at = [], 0
    for line in text.split("\n"):
        sentences, start, i = [], 0, 0
        while i < len(line):
            if line[i] in ".!?" and (i + 1 == len(line) or (line[i + 1] not in ".!?" and line[i + 1].isspace())):
                sentences.append((start, i + 1))
                start = i + 1
            i += 1
        sentences.append((start, len(line)))
        found = []
        for a, b in sentences:
            part = line[a:b]
            if part.split():
                found.append((at + a + len(part) - len(part.lstrip()), at + a + len(part.rstrip()), tuple(part.split())))
        if found:
            lines.append(found)
        at += len(line) + 1
    return lines


def spans_brute(rows, line_words, run_words):
    """From the definition: the first place of each unit's words; then repeated long lines, then runs of repeats."""
    first, docs = {}, []
    for row, (i, text) in enumerate(rows):
        key = 2**63 - 1 if i is None else i
        lines = plain_units(text or "")
        docs.append((key, row, lines))
        for found in lines:
            whole = sum((x[2] for x in found), ())
            for start, words_, many in [(found[0][0], whole, len(found) > 1)] + [(x[0], x[2], False) for x in found]:
                place = (key, row, start, not many)
                first[words_] = min(first.get(words_, place), place)
    null = lambda k: None if k == 2**63 - 1 else k
    out = []
    for key, row, lines in docs:
        runs, near = [], False
        for found in lines:
            whole = sum((x[2] for x in found), ())
            many = len(found) > 1
            if len(whole) >= line_words and first[whole] != (key, row, found[0][0], not many):
                out.append((null(key), found[0][0], found[-1][1], len(whole), 1, null(first[whole][0])))
                near = False
                continue
            for x in found:
                # a line of one sentence that is long but no repeat is no part of a run either
                if first[x[2]] != (key, row, x[0], True):
                    if near:
                        runs[-1].append(x)
                    else:
                        runs.append([x])
                    near = True
                else:
                    near = False
        for run in runs:
            n = sum(len(x[2]) for x in run)
            if n >= run_words:
                out.append((null(key), run[0][0], run[-1][1], n, len(run), null(first[run[0][2]][0])))
    return sorted(out, key=repr)


def repeats_rows():
    rng = random.Random(4)
    sentence = lambda n: words(rng, n).capitalize() + "."
    passage = " ".join(sentence(rng.randrange(4, 14)) for _ in range(8))
    shared, short = sentence(23), sentence(6)
    rows = []
    for k in range(30):
        lines = [" ".join(sentence(rng.randrange(1, 12)) for _ in range(rng.randrange(1, 6))) for _ in range(4)]
        if k % 3 == 0:
            lines.insert(2, shared)
        if k % 4 == 0:
            lines.insert(1, short)
        if k % 5 == 0:
            lines[1] = lines[1][:-1] + " " + passage + " tail of " + lines[1]
        rows.append((k, "\n".join(lines)))
    listed = "\n".join(sentence(5) for _ in range(7))
    rows += [(33, f"Own start.\n{listed}"), (34, f"{listed}\n\nOwn end of it.")]
    return rows + [(40, None), (41, ""), (42, "\n \n"), (None, rows[3][1]), (7, rows[7][1]), (50, "no end of sentence here at all\tand  spaces"), (51, "no end of sentence here at all and spaces"), (52, "...!? . ?")]


@pytest.mark.parametrize("line_words", [5, 20])
def test_repeated_spans_equal_brute_force(spark, line_words):
    rows = repeats_rows()
    got = [tuple(r) for r in unit_dedup.repeated_spans(frame(spark, rows).coalesce(1), line_words, 20, stretch=False).collect()]
    assert sorted(got, key=repr) == spans_brute(rows, line_words, 20)
    assert {r[0] for r in got} >= {5, 10, 15, 20, 25}, "the passage is found wherever it was pasted"
    assert 34 in {r[0] for r in got}, "short lines make a run"


def without_spans(text, spans):
    out, at = [], 0
    for start, end in sorted(spans):
        out.append(text[at:start])
        at = max(at, end)
    return "".join([*out, text[at:]])


def test_repeats_are_removed_and_offsets_kept(spark):
    rows = repeats_rows() + [(60, "é🙂 " + repeats_rows()[0][1] + " 🙂é")]
    docs = spark.createDataFrame([(i, t, "x", k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, row string, id int").coalesce(1)
    got = unit_dedup.remove_repeats(docs, stretch=False)
    assert got.columns == [*docs.columns, "kept_spans"]
    spans = {}
    for i, a, b, *_ in spans_brute(rows, 20, 20):
        spans.setdefault(i, []).append((a, b))
    for r in got.collect():
        original = rows[r.id][1]
        assert r.row == "x" and r.doc_id == rows[r.id][0]
        if r.doc_id != 7:
            assert r.text == (None if original is None else without_spans(original, spans.get(r.doc_id, [])))
        assert "".join(original[p.start_char : p.end_char] for p in r.kept_spans) == (r.text or "") if original else r.kept_spans == []
    assert sum(len(r.text or "") for r in got.collect()) < sum(len(t or "") for _, t in rows)
    assert unit_dedup.remove_repeats(docs.where("id < 0")).count() == 0


def test_a_line_of_one_sentence_meets_the_sentence_inside_a_line(spark):
    licence = words(random.Random(8), 60) + "."
    rows = [(1, licence), (2, f"Before it. {licence} After it."), (3, f"x\n{licence}\ny"), (5, "Some day. Nine words of a line that comes later."), (6, "Nine words of a line that comes later.")]
    got = sorted(tuple(r) for r in unit_dedup.repeated_spans(frame(spark, rows), line_words=5).collect())
    n = len(licence)
    assert got == [(2, 11, 11 + n, 60, 1, 1), (3, 2, 2 + n, 60, 1, 1), (6, 0, 38, 8, 1, 5)]


def test_runs_stretch_over_cut_sentences(spark):
    rng = random.Random(9)
    a, b, c, x, y = words(rng, 30).split(), words(rng, 6), words(rng, 30).split(), words(rng, 12), words(rng, 12)
    head, tail = " ".join(a[8:]), " ".join(c[:18])
    first = f"{' '.join(a)}. {b}.   {' '.join(c)}."
    later = f"{x} {head}.     {b}. {tail} {y}."
    edited = f"{x}. {' '.join(a)}. {b}. {' '.join(c[:18])} changed {' '.join(c[19:])}. {b}. {y}."
    rows = [(1, first), (2, later), (3, f"{b}. {y} {x}."), (4, edited)]
    got = sorted(tuple(r) for r in unit_dedup.repeated_spans(frame(spark, rows)).collect())
    start = later.index(head)
    assert got[0] == (2, start, later.index(tail) + len(tail), 22 + 6 + 18, 1, 1)
    span = next(g for g in got if g[0] == 4)
    assert edited[span[1] : span[2]] == edited[edited.index(a[0]) : edited.index(" changed")]
    assert (span[3], span[4], span[5]) == (30 + 6 + 18, 2, 1)
    assert not any(g[0] in (1, 3) for g in got)


@given(st.text("ab .!\n\té", max_size=60))
def test_units_cover_all_words_in_order(text):
    found = list(unit_dedup.units(text))
    lines = [u for u in found if u[0] == unit_dedup.LINE]
    assert " ".join(u[4] for u in lines).split() == text.split()
    for _, _, start, end, norm in found:
        assert text[start:end].split() == norm.split()


def test_repeated_spans_of_no_rows(spark):
    assert unit_dedup.repeated_spans(frame(spark, [])).count() == 0
