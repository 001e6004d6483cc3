"""Substring deduplication by hashing lines and sentences.

Every line, and every sentence of a line that has several, is a unit: its text with white space normalised has a
128-bit digest. Digests are grouped globally, lines of one sentence with sentences of longer lines; the earliest
occurrence, by (doc_id, place), stays, and later ones are repeats. A repeated line of at least `line_words` words goes as
a whole. Elsewhere a run of neighbouring repeats, short lines and sentences, goes if it has at least `run_words` words,
so that short common lines and sentences stay where they are, while a passage pasted into other text is found by the
units inside it. Spans are offsets of the original text; `remove_repeats` cuts them out and keeps the offsets of what
stays.

Nulls and ties: a null or empty text has no units; a null id ranks after all others; repeated rows rank by row
number, so the first stays. Very long texts are read whole, one at a time. No rows give no rows. Columns other than
doc_id and text are not read by `repeated_spans`; `remove_repeats` carries them, with any names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LONG_MAX, pieces, scratch

_LINE = re.compile(r"[^\n]+")
#: A sentence ends with stops before white space or the line's end.
_SENTENCE = re.compile(r"[^.!?]*(?:[.!?]+(?!\s|\Z)[^.!?]+)*[.!?]*\s*")
_WORD = re.compile(r"\S+")
LINE, SENTENCE = 0, 1


def units(text: str) -> Iterator[tuple[int, int, int, int, str]]:
    """(kind, line, start, end, normalised text) of all lines with words, and of their sentences if there are
    several. start and end leave out white space at the ends."""
    for number, line in enumerate(_LINE.finditer(text)):
        found = []
        for s in _SENTENCE.finditer(text, line.start(), line.end()):
            part = s.group()
            norm = " ".join(part.split())
            if norm:
                at = s.start() + len(part) - len(part.lstrip())
                found.append((SENTENCE, number, at, s.start() + len(part.rstrip()), norm))
        if found:
            yield LINE, number, found[0][2], found[-1][3], " ".join(x[4] for x in found)
        if len(found) > 1:
            yield from found


_FIELDS = [("row", pa.int64()), ("id", pa.int64()), ("kind", pa.int8()), ("line", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("words", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("spot", pa.int64())]
_MOST = 2**16 - 1


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Units with digests. spot is the number of a sentence in its text and, in 16 bits each, the words of the one
    before and of the one after it; a line of one sentence has its sentence's, other lines none."""
    schema = pa.schema(_FIELDS)
    for batch in batches:
        for rows, ids, texts in pieces(batch, "row", "id", "text"):
            out: list[list] = [[] for _ in _FIELDS]
            for row, i, text in zip(rows, ids, texts, strict=True):
                found = list(units(text or ""))
                spots = dict.fromkeys(range(len(found)))
                told = [k for k in spots if found[k][0] == SENTENCE or k + 1 == len(found) or found[k + 1][0] == LINE]
                sizes = [0, *(min(found[k][4].count(" ") + 1, _MOST) for k in told), 0]
                for seq, k in enumerate(told):
                    spots[k] = seq << 32 | sizes[seq] << 16 | sizes[seq + 2]
                for k, (kind, line, start, end, norm) in enumerate(found):
                    d = xxhash.xxh128_intdigest(norm.encode("utf-8", "surrogatepass"))
                    for to, x in zip(out, (row, i, kind, line, start, end, norm.count(" ") + 1, (d >> 64) - 2**63, (d & (2**64 - 1)) - 2**63, spots[k]), strict=True):
                        to.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, (_, t) in zip(out, _FIELDS, strict=True)], schema=schema)


def _picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sentences of texts whose numbers are wanted, and whether their lines are removed."""
    for batch in batches:
        for rows, texts, wanted, lines in pieces(batch, "row", "text", "wanted", "gone"):
            out: list[tuple] = []
            for row, text, seqs, gone in zip(rows, texts, wanted, lines, strict=True):
                found, want, gone, seq = list(units(text or "")), set(seqs), set(gone or ()), 0
                for k, (kind, line, start, end, _) in enumerate(found):
                    if kind == SENTENCE or k + 1 == len(found) or found[k + 1][0] == LINE:
                        if seq in want:
                            out.append((row, seq, line in gone, start, text[start:end]))
                        seq += 1
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["row", "seq", "gone", "start", "text"])


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many words of a sentence agree with another's, from the end (left edges) or from the start, and where the
    sentence's words start and end."""
    for batch in batches:
        for rows, runs, seqs, left, starts, gone, mine, theirs in pieces(batch, "row", "run", "seq", "left", "start", "gone", "mine", "theirs"):
            counts, froms, tos = [], [], []
            for is_left, start, a, b in zip(left, starts, mine, theirs, strict=True):
                places = [m.span() for m in _WORD.finditer(a)]
                pairs = zip(reversed(a.split()), reversed(b.split())) if is_left else zip(a.split(), b.split())
                k = 0
                for x, y in pairs:
                    if x != y:
                        break
                    k += 1
                counts.append(k)
                froms.append([start + x for x, _ in places])
                tos.append([start + x for _, x in places])
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(runs, pa.int64()), pa.array(seqs, pa.int32()), pa.array(left, pa.bool_()), pa.array(gone, pa.bool_()), pa.array(counts, pa.int32()), pa.array(froms, pa.list_(pa.int32())), pa.array(tos, pa.list_(pa.int32()))],
                names=["row", "run", "seq", "left", "gone", "agree", "froms", "tos"],
            )


def _stretched(runs: DataFrame, first: DataFrame, texts: DataFrame, gone: DataFrame, run_words: int) -> DataFrame:
    """runs with start and end moved outwards as far as the words around them are those around the earliest occurrence
    of their outermost sentences; `total` counts these words too where a removed line has them. Only the next sentence
    matters: one that agrees as a whole is a repeat itself, and in the run. So runs that have too few words with both
    next sentences in full are left out before texts are read."""
    seq = lambda c: F.shiftright(c, 32).cast("int")
    most = F.col("words") + F.shiftright("head.spot", 16).bitwiseAND(_MOST) + F.col("tail.spot").bitwiseAND(_MOST)
    runs = scratch(runs.where(most >= min(run_words, _MOST)), "unit-runs")
    edges = [runs.select("row", "run", (seq(f"{at}.spot") + by).alias("seq"), F.lit(by < 0).alias("left"), f"{at}.h1", f"{at}.h2") for at, by in (("head", -1), ("tail", 1))]
    edges = edges[0].unionByName(edges[1]).join(first.select("h1", "h2", F.col("first.row").alias("row1"), seq("first.spot").alias("seq1")), ["h1", "h2"])
    edges = scratch(edges.select("row", "run", "seq", "left", "row1", (F.col("seq1") + F.when(F.col("left"), -1).otherwise(1)).alias("seq1")), "unit-edges")
    wanted = edges.select("row", "seq").unionByName(edges.select(F.col("row1").alias("row"), F.col("seq1").alias("seq"))).groupBy("row").agg(F.collect_set("seq").alias("wanted"))
    near = scratch(texts.join(wanted, "row").join(gone, "row", "left").mapInArrow(_picked, "row long, seq int, gone boolean, start int, text string"), "unit-near")
    mine = near.withColumnRenamed("text", "mine")
    theirs = near.select(F.col("row").alias("row1"), F.col("seq").alias("seq1"), F.col("text").alias("theirs"))
    both = edges.join(mine, ["row", "seq"]).join(theirs, ["row1", "seq1"]).select("row", "run", "seq", "left", "start", "gone", "mine", "theirs")
    found = both.mapInArrow(_agreeing, "row long, run long, seq int, left boolean, gone boolean, agree int, froms array<int>, tos array<int>").where("agree > 0")
    # of a sentence between two runs, words that the first one takes aren't the second one's
    taken = F.coalesce(F.max(F.when(~F.col("left"), F.col("agree"))).over(Window.partitionBy("row", "seq")), F.lit(0))
    found = found.withColumn("agree", F.when(F.col("left"), F.least("agree", F.size("froms") - taken)).otherwise(F.col("agree"))).where("agree > 0")
    moved = found.groupBy("row", "run").agg(
        F.sum("agree").alias("more"), F.coalesce(F.sum(F.when(~F.col("gone"), F.col("agree"))), F.lit(0)).alias("own"),
        F.min(F.when(F.col("left") & ~F.col("gone"), F.element_at("froms", F.size("froms") - F.col("agree") + 1))).alias("from"),
        F.max(F.when(~F.col("left") & ~F.col("gone"), F.element_at("tos", F.col("agree")))).alias("to"),
    )
    return runs.join(moved, ["row", "run"], "left").withColumns({
        "start": F.coalesce("from", "start"), "end": F.coalesce("to", "end"),
        "total": F.col("words") + F.coalesce("more", F.lit(0)), "words": F.col("words") + F.coalesce("own", F.lit(0)),
    })


def _spans(keyed: DataFrame, line_words: int, run_words: int, stretch: bool) -> DataFrame:
    """keyed(row, id, text), read as often as it is needed: (row, id, start, end, words, units, first_id)."""
    cut = scratch(keyed.mapInArrow(_cut, "row long, id long, kind byte, line int, start int, end int, words int, h1 long, h2 long, spot long"), "unit-rows")
    place = F.struct("id", "row", "start", "spot")
    # by digest alone: a line of one sentence meets the same sentence inside a longer line
    groups = cut.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("id").alias("first_id")).where("n > 1")
    groups = scratch(groups.select("h1", "h2", "first_id"), "unit-groups")
    shared = scratch(cut.join(groups, ["h1", "h2"]), "unit-shared")
    # the earliest among equal ids is settled on the few rows that carry the group's first id
    first = scratch(shared.where("id = first_id").groupBy("h1", "h2").agg(F.min(place).alias("first")), "unit-first")
    repeats = shared.where("id <> first_id").unionByName(shared.where("id = first_id").join(first, ["h1", "h2"]).where(place != F.col("first")).drop("first"))
    # digests are kept where a run can end
    repeats = repeats.withColumns({h: F.when(F.lit(stretch) & ((F.col("kind") == SENTENCE) | (F.col("words") < line_words)), F.col(h)) for h in ("h1", "h2")})
    repeats = scratch(repeats, "unit-repeats")
    lines = repeats.where((F.col("kind") == LINE) & (F.col("words") >= line_words))
    # sentences, and lines of one sentence, that no removed line has; all by row, so that they move once
    gone = scratch(lines.groupBy("row").agg(F.collect_set("line").alias("gone")), "unit-gone")
    short = (F.col("kind") == LINE) & (F.col("words") < line_words) & F.col("spot").isNotNull()
    sentences = repeats.where((F.col("kind") == SENTENCE) | short).join(gone, "row", "left")
    sentences = sentences.where(~F.coalesce(F.array_contains("gone", F.col("line")), F.lit(False))).drop("gone", "kind")
    by = Window.partitionBy("row").orderBy("spot")
    number = F.shiftright("spot", 32)
    new = F.coalesce((number - F.lag(number).over(by) > 1).cast("int"), F.lit(1))
    runs = sentences.withColumn("new", new).withColumn("run", F.sum("new").over(by))
    runs = runs.groupBy("row", "id", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").alias("words"), F.count("*").alias("units"),
        F.min(F.struct("start", "first_id", "spot", "h1", "h2")).alias("head"), F.max(F.struct("start", "spot", "h1", "h2")).alias("tail"),
    )
    runs = _stretched(runs, first, keyed.select("row", "text"), gone, run_words).where(F.col("total") >= run_words) if stretch else runs.where(F.col("words") >= run_words)
    return lines.select("row", "id", "start", "end", F.col("words").cast("long").alias("words"), F.lit(1).cast("long").alias("units"), "first_id").unionByName(
        runs.select("row", "id", "start", "end", "words", "units", F.col("head.first_id").alias("first_id"))
    )


def _keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """A row number, which has to be data, as it is read again; an id that isn't null; and the columns."""
    return scratch(docs.select(F.monotonically_increasing_id().alias("row"), F.coalesce(F.col("doc_id"), F.lit(LONG_MAX)).cast("long").alias("id"), *columns), "unit-texts")


def repeated_spans(docs: DataFrame, line_words: int = 20, run_words: int = 20, stretch: bool = True) -> DataFrame:
    """docs(doc_id, text): a row per removed span: doc_id, start_char, end_char, n_words, n_units, keep_doc_id (of
    the earliest occurrence of the span's first unit). Groups are summed before the shuffle and joined back,
    so a line that a third of all documents share is no task of its own. With `stretch`, runs are stretched over the
    words on both sides that their earliest occurrence has too, and the minimum holds for the stretched run."""
    spans = _spans(_keyed(docs, "text"), line_words, run_words, stretch)
    null = lambda c: F.when(F.col(c) != LONG_MAX, F.col(c))
    return spans.select(null("id").alias("doc_id"), F.col("start").alias("start_char"), F.col("end").alias("end_char"), F.col("words").alias("n_words"), F.col("units").alias("n_units"), null("first_id").alias("keep_doc_id"))


_PIECES = "array<struct<start_char:int,end_char:int>>"


def pieces_left(spans, length):
    """What is left of a text of `length` characters without the spans, an array of structs with start and end that may
    be null: an array of structs with start_char and end_char, in order."""
    none = F.array().cast(_PIECES)
    piece = lambda a, b: F.when(a < b, F.array(F.struct(a.alias("start_char"), b.alias("end_char"))).cast(_PIECES)).otherwise(none)
    begin = F.struct(F.lit(0).alias("at"), none.alias("left"))
    step = lambda s, x: F.struct(F.greatest(s.at, x.end).alias("at"), F.concat(s.left, piece(s.at, x.start)).alias("left"))
    return F.aggregate(F.array_sort(F.coalesce(spans, F.array().cast("array<struct<start:int,end:int>>"))), begin, step, lambda s: F.concat(s.left, piece(s.at, length)))


def remove_repeats(docs: DataFrame, line_words: int = 20, run_words: int = 20, stretch: bool = True) -> DataFrame:
    """docs with its repeats cut out of text, and kept_spans: the offsets, in the original text, of the pieces that the
    new text is made of. Null texts stay null. A row's spans are gathered, which its own text bounds."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")
    keyed = _keyed(docs.select("doc_id", "text", row), "text", "doc")
    spans = _spans(keyed.select("row", "id", "text"), line_words, run_words, stretch)
    by_row = spans.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    held = keyed.join(by_row, "row", "left").withColumn("kept_spans", pieces_left(F.col("spans"), F.coalesce(F.char_length("text"), F.lit(0))))
    cut = F.array_join(F.transform("kept_spans", lambda p: F.substring(F.col("text"), p.start_char + 1, p.end_char - p.start_char)), "")
    text = F.when(F.col("text").isNull() | F.col("spans").isNull(), F.col("text")).otherwise(cut)
    return held.select(*((text if c == "text" else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns), "kept_spans")
