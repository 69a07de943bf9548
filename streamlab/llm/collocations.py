"""Phrase collocations from count streams in prefix and in suffix order.

Texts are lower-cased (A-Z), split into pieces at ``BREAKS`` and these into words. Everything is
per language. Candidates are phrases of two to three words that occur ``LEAST`` times or more. Cut
after its first k words, a phrase with a occurrences scores floor(1,000,000 a a / (l r)), l and r
the occurrences of the two parts; its lowest-scoring cut counts, the first of equal ones. A
candidate inside a longer one that has half its occurrences or more is dropped.

1. Counting. Tasks count the phrases of a megabyte of text at once and Spark adds the counts
   up; a phrase that every text holds is one row per such run. A phrase of three words is counted
   only where both of its pairs are frequent, by a bit table sized by the number of frequent pairs.
2. Prefix order. All frequent phrases as one stream sorted by (language, words): a phrase follows
   its beginnings, so one pass in lockstep gives every phrase the counts of its left parts, and
   every pair the largest count of a phrase that extends it to the right.
3. Suffix order. The same rows, with what they carry, sorted by their words from the last to the
   first: the same pass gives the counts of the right parts and the extensions to the left.

A pass reads a range-partitioned stream: a word or pair that begins a third of all phrases spans
several tasks. What a task needs from the one before it (the last word and pair it saw) is written
beside the rows, three at most per task, and joined to the rows left open.

Scores are whole-number divisions of 38-digit decimals: exact up to 10^15 occurrences.

Handling of odd input: a NULL text is empty, a NULL language ``und``; texts without words, and
words of any length, are fine, and very long texts are taken whole; every row counts, also
repeated rows and rows with NULL or equal ids; ties end with the phrase in UTF-8 byte order; an
empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamlab.llm.kernels import LOWER, Words, mix, runs, utf8
from streamlab.llm.session import bit_table, is_set, table_bits, written

LEAST = 10
TOP = 2_000
KEPT_SHARE = 50  # percent of a phrase's occurrences in a longer candidate that drop it
SCALE = 1_000_000
NO_LANGUAGE = "und"
BREAKS = b".,;:!?\n\x0b\x0c\r"
RUN_BYTES = 1 << 20
_IS_BREAK = np.zeros(256, bool)
_IS_BREAK[list(BREAKS)] = True
_IS_WORD = ~_IS_BREAK
_IS_WORD[[0x20, 0x09]] = False
_FIRST, _SECOND = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class Run:
    """The words of some documents: numbers in a dictionary of the run, languages and pieces."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, languages: pa.Array):
        self.words = Words(LOWER[data], offsets, _IS_WORD)
        w = self.words
        size = w.ends - w.starts
        ends = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=ends[1:])
        inside = np.repeat(w.starts - ends[:-1], size) + np.arange(ends[-1])
        text = pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(w.data[inside])))
        encoded = text.dictionary_encode()
        self.dictionary, self.number = encoded.dictionary, encoded.indices.to_numpy().astype(np.int64)
        languages = languages.dictionary_encode()
        self.languages = languages.dictionary
        doc = w.doc_index()
        self.language = languages.indices.to_numpy().astype(np.int64)[doc]
        breaks = np.cumsum(_IS_BREAK[w.data])[w.starts] if len(size) else doc
        # words of one piece: neither a break nor the end of the document between them
        self.joined = (doc[1:] == doc[:-1]) & (breaks[1:] == breaks[:-1])

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places, first place of each distinct pair, number of the pair at each place)."""
        place = np.flatnonzero(self.joined)
        v = max(1, len(self.dictionary))
        key = (self.language[place] * v + self.number[place]) * v + self.number[place + 1]
        _, first, number = np.unique(key, return_index=True, return_inverse=True)
        return place, place[first], number

    def rows(self, places: np.ndarray, counts: np.ndarray, n: int) -> pa.RecordBatch:
        """Phrases of n words that start at these places, with their counts."""
        columns = [pc.take(self.languages, pa.array(self.language[places]))]
        for k in range(3):
            words = pc.take(self.dictionary, pa.array(self.number[places + k])) if k < n else pa.nulls(len(places), pa.string())
            columns.append(words.cast(pa.string()))
        return pa.RecordBatch.from_arrays([columns[0].cast(pa.string()), *columns[1:], pa.array(counts.astype(np.int64))], _NAMES)


_NAMES = ["lang", "w1", "w2", "w3", "n"]
_COUNTS = "lang string, w1 string, w2 string, w3 string, n long"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[Run]:
    for batch in batches:
        data, offsets = utf8(batch["text"])
        for a, b in runs(offsets, RUN_BYTES):
            yield Run(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], batch["lang"].slice(a, b - a))
        pa.default_memory_pool().release_unused()


def _words_and_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words, of pairs and (without a word) of all words."""
    for run in _runs(batches):
        if not len(run.number):
            continue
        key = run.language * len(run.dictionary) + run.number
        _, first, count = np.unique(key, return_index=True, return_counts=True)
        yield run.rows(first, count, 1)
        _, first, number = run.pairs()
        yield run.rows(first, np.bincount(number, minlength=len(first)), 2)
        _, first, count = np.unique(run.language, return_index=True, return_counts=True)
        yield run.rows(first, count, 0)


def _language_hashes(languages: pa.Array) -> np.ndarray:
    found = [int.from_bytes(hashlib.blake2b((x or "").encode(), digest_size=8).digest(), "little") for x in languages.to_pylist()]
    return np.array(found, np.uint64)


def _pair_hash(language: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return mix(language + one * _FIRST + two * _SECOND)


def _pair_places(bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    whole = np.ones(256, bool)
    for batch in batches:
        one, two = (Words(*utf8(batch[c]), whole).hashes() for c in ("w1", "w2"))
        languages = batch["lang"].dictionary_encode()
        hashes = _language_hashes(languages.dictionary)[languages.indices.to_numpy()] if batch.num_rows else one
        place = (_pair_hash(hashes, one, two) >> np.uint64(64 - bits)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(place)], ["place"])


def _triples(bits: int, sent, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of phrases of three words of which both pairs are in the table."""
    for run in _runs(batches):
        place, first, number = run.pairs()
        if not len(place):
            continue
        hashes = run.words.hashes()
        name = _pair_hash(_language_hashes(run.languages)[run.language[first]], hashes[first], hashes[first + 1])
        often = is_set(sent.value, (name >> np.uint64(64 - bits)).astype(np.int64))
        at = np.full(len(run.number), -1)  # number of the frequent pair that starts at each word
        good = often[number]
        at[place[good]] = number[good]
        start = np.flatnonzero((at[:-1] >= 0) & (at[1:] >= 0))
        key = at[start] * len(run.dictionary) + run.number[start + 2]
        _, first, count = np.unique(key, return_index=True, return_counts=True)
        yield run.rows(start[first], count, 3)


def _added(counts: DataFrame) -> DataFrame:
    return counts.groupBy("lang", "w1", "w2", "w3").agg(F.sum("n").alias("n"))


def frequent(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(phrases of one to three words with ``least`` occurrences or more, words per language)."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"))
    short = _added(texts.mapInArrow(_words_and_pairs, _COUNTS)).where((F.col("n") >= least) | F.col("w1").isNull())
    short = written(short, "words_and_pairs")
    pairs = short.where("w2 is not null")
    bits = table_bits(pairs.count())
    places = pairs.select("lang", "w1", "w2").mapInArrow(partial(_pair_places, bits), "place long")
    sent = spark.sparkContext.broadcast(bit_table(places, bits))
    long = _added(texts.mapInArrow(partial(_triples, bits, sent), _COUNTS)).where(F.col("n") >= least)
    totals = short.where("w1 is null").select("lang", F.col("n").alias("words"))  # a row per language
    return written(short.where("w1 is not null").unionByName(long), "phrases"), totals


ROW, LAST_WORD, LAST_PAIR, LEAD = range(4)
_KEYS = ["lang", "x1", "x2", "x3"]


def _changes(column: pa.Array, before: str | None) -> np.ndarray:
    """Whether each value differs from the one before it."""
    out = np.ones(len(column), bool)
    out[1:] = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    out[0] = column[0].as_py() != before
    return out


def _lockstep(names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One pass over sorted phrases: counts of the parts they begin with, largest extension of pairs.

    Rows with ``kind`` other than ROW say what the next task needs: the last word and the last pair
    of this one, and the largest count among the leading phrases whose pair an earlier task has.
    """
    before = [None, None, None]  # language, first and second word of the row before
    one = two = lead = -1  # count of the open word, of the open pair; extension of a pair not seen here
    open_pair, longest = None, 0  # the open pair's row, held back until all its extensions were seen
    lead_key = last_word = last_pair = None

    def extra(kind: int, key: tuple, n: int) -> pa.RecordBatch:
        values = dict(zip(_KEYS, key)) | {"n": n, "kind": kind}
        return pa.RecordBatch.from_pylist([{c: values.get(c) for c in schema.names}], schema)

    schema = None
    for batch in batches:
        if schema is None:
            known = [f for f in batch.schema if f.name in names]
            schema = pa.schema([*known, *((c, pa.int64()) for c in ("p1", "p2", "ext")), ("kind", pa.int32())])
        size = batch.num_rows
        if not size:
            continue
        lang, x1 = batch["lang"], batch["x1"]
        x2, x3 = (pc.fill_null(batch[c], "") for c in ("x2", "x3"))
        n = batch["n"].to_numpy()
        single, triple = (pc.equal(x2, "").to_numpy(zero_copy_only=False), pc.not_equal(x3, "").to_numpy(zero_copy_only=False))
        pair = ~single & ~triple
        new_word = _changes(lang, before[0]) | _changes(x1, before[1])
        new_pair = new_word | _changes(x2, before[2])
        row = np.arange(size)
        at1 = np.maximum.accumulate(np.where(new_word, row, -1))
        at2 = np.maximum.accumulate(np.where(new_pair, row, -1))
        p1 = np.where(at1 < 0, one, np.where(single[at1], n[at1], -1))
        p2 = np.where(at2 < 0, two, np.where(pair[at2], n[at2], -1))
        # extensions, for each stretch of rows with the same pair
        begins = np.flatnonzero(new_pair)
        stretch = np.concatenate([[0], begins]) if not new_pair[0] else begins
        most = np.maximum.reduceat(np.where(triple, n, 0), stretch)
        if not new_pair[0]:  # goes on with the open pair
            if open_pair is not None:
                longest = max(longest, int(most[0]))
            elif triple[0]:
                lead_key, lead = (lang[0].as_py(), x1[0].as_py(), x2[0].as_py()), max(lead, int(most[0]))
            most, stretch = most[1:], stretch[1:]
        if len(stretch) and open_pair is not None:
            yield _with(open_pair, longest, schema)
            open_pair = None
        ext = np.zeros(size, np.int64)
        if len(stretch):
            ext[stretch] = most
            if before[0] is None and triple[stretch[0]]:  # the first rows of the task extend an earlier one's pair
                s = int(stretch[0])
                lead_key, lead = (lang[s].as_py(), x1[s].as_py(), x2[s].as_py()), int(most[0])
        out = pa.RecordBatch.from_arrays(
            [*(batch[f.name] for f in schema if f.name in names), *_known(p1, p2), pa.array(np.where(pair, ext, 0)), pa.nulls(size, pa.int32()).fill_null(ROW)],
            schema=schema,
        )
        for flags, width in ((single, 2), (pair, 3)):
            if flags.any():
                k = int(np.flatnonzero(flags)[-1])
                key = tuple(c[k].as_py() for c in (lang, x1, x2)[:width]), int(n[k])
                last_word, last_pair = (key, last_pair) if width == 2 else (last_word, key)
        held = int(stretch[-1]) if len(stretch) and pair[stretch[-1]] else None
        if held is not None:
            open_pair, longest = out.slice(held, 1), int(most[-1])
            yield out.slice(0, held)
            out = out.slice(held + 1)
        yield out
        one, two = int(p1[-1]), int(p2[-1]) if not single[-1] else -1
        before = [lang[size - 1].as_py(), x1[size - 1].as_py(), x2[size - 1].as_py()]
    if open_pair is not None:
        yield _with(open_pair, longest, schema)
    for kind, last in ((LAST_WORD, last_word), (LAST_PAIR, last_pair)):
        if last is not None:
            yield extra(kind, *last)
    if lead_key is not None:
        yield extra(LEAD, lead_key, lead)


def _known(*counts: np.ndarray) -> list[pa.Array]:
    return [pa.array(c.astype(np.int64), mask=c < 0) for c in counts]


def _with(row: pa.RecordBatch, ext: int, schema: pa.Schema) -> pa.RecordBatch:
    at = schema.names.index("ext")
    return row.set_column(at, schema.field(at), pa.array([ext], pa.int64()))


def merged(stream: DataFrame, words: list[Column], kept: list[str]) -> DataFrame:
    """``stream`` with, in the order of ``words``, counts p1 and p2 of the parts that a phrase begins
    with (its first word, its first two) and ext, the largest count of a phrase that extends a pair."""
    names = [*_KEYS, "n", *kept]
    keyed = stream.select("lang", *(w.alias(f"x{k}") for k, w in enumerate(words, 1)), "n", *kept)
    in_order = keyed.repartitionByRange(*_KEYS).sortWithinPartitions(*_KEYS)
    schema = ", ".join([f"{c} {t}" for c, t in in_order.select(*names).dtypes] + ["p1 long, p2 long, ext long, kind int"])
    passed = written(in_order.select(*names).mapInArrow(partial(_lockstep, names), schema), "in_order")
    # what tasks left open: a few rows per task
    last_word = passed.where(F.col("kind") == LAST_WORD).select("lang", "x1", F.col("n").alias("word_before"))
    last_pair = passed.where(F.col("kind") == LAST_PAIR).select("lang", "x1", "x2", F.col("n").alias("pair_before"))
    lead = passed.where(F.col("kind") == LEAD).groupBy("lang", "x1", "x2").agg(F.max("n").alias("longer_behind"))
    rows = passed.where(F.col("kind") == ROW)
    rows = rows.join(F.broadcast(last_word), ["lang", "x1"], "left")
    for side in (last_pair, lead):
        rows = rows.join(F.broadcast(side), ["lang", "x1", "x2"], "left")
    pair = F.col("x2").isNotNull() & F.col("x3").isNull()
    return rows.select(
        *names,
        F.coalesce("p1", "word_before").alias("p1"),
        F.when(F.col("x3").isNotNull(), F.coalesce("p2", "pair_before")).alias("p2"),
        F.when(pair, F.greatest("ext", "longer_behind")).alias("ext"),
    )


def score(a: str, left: str, right: str) -> Column:
    """floor(SCALE a a / (l r)), exactly."""
    whole = "cast({} as decimal(18,0))".format
    return F.expr(f"cast({SCALE} as decimal(7,0)) * {whole(a)} * {whole(a)} div ({whole(left)} * {whole(right)})")


def collocations(docs: DataFrame, least: int = LEAST, top: int | None = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases."""
    stream, totals = frequent(docs, least)
    first, second, third = (F.col(f"w{k}") for k in (1, 2, 3))
    rows = merged(stream, [first, second, third], [])
    rows = rows.withColumnsRenamed({"x1": "w1", "x2": "w2", "x3": "w3", "p1": "l1", "p2": "l2", "ext": "longer_right"})
    # from the last word to the first
    backwards = [F.coalesce(third, second, first), F.when(third.isNotNull(), second).when(second.isNotNull(), first), F.when(third.isNotNull(), first)]
    rows = merged(rows, backwards, ["l1", "l2", "longer_right"])
    triple = F.col("x3").isNotNull()
    phrases = rows.where("x2 is not null").select(
        "lang", "n", "longer_right", F.col("ext").alias("longer_left"),
        F.when(triple, F.concat_ws(" ", "x3", "x2", "x1")).otherwise(F.concat_ws(" ", "x2", "x1")).alias("phrase"),
        F.col("l1"), F.when(triple, F.col("p2")).otherwise(F.col("p1")).alias("r1"),
        F.when(triple, F.col("l2")).alias("l2"), F.when(triple, F.col("p1")).alias("r2"),
    )
    longer = F.greatest("longer_right", "longer_left")
    phrases = phrases.where(~F.coalesce(100 * longer >= KEPT_SHARE * F.col("n"), F.lit(False)))
    cuts = phrases.withColumns({"s1": score("n", "l1", "r1"), "s2": score("n", "l2", "r2")})
    later = F.coalesce(F.col("s2") < F.col("s1"), F.lit(False))
    lowest = [F.when(later, F.col(f"{c}2")).otherwise(F.col(f"{c}1")).alias(name) for c, name in (("l", "l"), ("r", "r"), ("s", "score"))]
    cuts = cuts.select("lang", "phrase", F.col("n").alias("a"), *lowest)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = cuts.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    ranked = ranked.join(F.broadcast(totals), "lang")
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("words").alias("n"), "score")
