"""Phrases whose words stand together, from exact counts in counting quotient filters.

Words are counted first, in batches of texts, and those found often enough get
gapless numbers; a phrase can only be frequent if its words are.  Each batch
then counts its pairs and triples of word numbers in a quotient filter, cuts it
by ranges of quotients, and the pieces of one range are merged, sorted as they
are.  What is frequent leaves the filters as rows and is scored by joins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clipledger.llm.quotient_filter import WIDEST, CountingFilter, Shape
from clipledger.llm.tokens import CHUNK_BYTES, slices
from clipledger.operators.ordering import global_position
from clipledger.operators.skew import lookup_join
from clipledger.session import stored

BATCH_BYTES = 16 << 20    # text in a batch
PART_WORDS = 2_000_000    # words of text for each range of quotients, on average
NO_LANG = "und"           # fixed value: the language of rows without one
_SCALE = 1_000_000

# What ends a piece, and what ends a word.
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_BREAK, _EDGE = np.zeros(256, bool), np.zeros(256, bool)
_BREAK[list(_BREAKS)] = True
_EDGE[list(_BREAKS + b" \t")] = True
_CUT = re.compile(rb"(?<=[^.,;:!? \x09-\x0D])[.,;:!? \x09-\x0D]")


def _segments(texts: list[bytes], size: int = CHUNK_BYTES) -> Iterator[tuple[bytes, bool]]:
    """The texts in portions of about `size` bytes, and whether a portion goes on inside a text.

    Short texts are joined by line feeds, which end pieces; a long one is cut behind words.
    """
    held: list[bytes] = []
    total = 0
    for text in texts:
        if held and total + len(text) > size:
            yield b"\n".join(held), False
            held, total = [], 0
        if len(text) <= size:
            held.append(text)
            total += len(text) + 1
            continue
        begin = 0
        while begin < len(text):
            found = _CUT.search(text, begin + size)
            end = found.start() if found else len(text)
            yield text[begin:end], begin > 0
            begin = end
    if held:
        yield b"\n".join(held), False


def tokens(raw: bytes, goes_on: bool = False) -> tuple[pa.Array, np.ndarray]:
    """The words of a text, A-Z in lower case, and which of them begin a piece."""
    data = np.frombuffer(raw, np.uint8)
    edge = _EDGE[data]
    change = np.flatnonzero(np.diff(edge.astype(np.int8), prepend=np.int8(1), append=np.int8(1)))
    start, end = change[::2], change[1::2]
    breaks = np.concatenate(([0], np.cumsum(_BREAK[data])))[start]
    begins = np.diff(breaks, prepend=0 if goes_on else -1) > 0
    low = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
    ends = np.concatenate(([0], np.cumsum(end - start))).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(low[~edge])]), begins


def _batch(number: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
    """One row: the words as numbers of this batch, and how often it has each (lang, word)."""
    by_lang: dict[str, list[bytes]] = {}
    for rows in held:
        for lang, text in zip(rows.column(0).to_pylist(), rows.column(1).cast(pa.binary()).to_pylist()):
            by_lang.setdefault(lang, []).append(text or b"")
    codes, langs, words, counts, totals, known = [], [], [], [], [], 0   # of every language
    for lang, texts in by_lang.items():
        found = [tokens(*s) for s in _segments(texts)]
        coded = pa.concat_arrays([w for w, _ in found]).dictionary_encode()
        own = coded.indices.to_numpy().astype(np.int64)
        begins = np.concatenate([b for _, b in found])
        codes.append((own + known) * 2 + begins)
        size = len(coded.dictionary)
        counts.append(np.bincount(own, minlength=size))
        words.append(coded.dictionary)
        langs.append(pa.repeat(lang, size))
        totals.append((lang, len(own)))
        known += size
    body = zstandard.ZstdCompressor(level=1).compress(np.concatenate(codes).astype("<i8").tobytes())
    listed = pa.StructArray.from_arrays(
        [pa.concat_arrays(langs), pa.concat_arrays(words).cast(pa.large_string()).cast(pa.string()),
         pa.array(np.concatenate(counts), pa.int64())], ["lang", "word", "n"])
    sums = pa.StructArray.from_arrays(
        [pa.array([t[0] for t in totals], pa.string()), pa.array([t[1] for t in totals], pa.int64())], ["lang", "n"])
    return pa.RecordBatch.from_arrays(
        [pa.array([number]), pa.array([body], pa.binary()), _one_list(listed), _one_list(sums)],
        ["batch", "codes", "words", "totals"])


def _one_list(items: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(items)], pa.int32()), items)


def _batches(docs: DataFrame, lang: str, text: str) -> DataFrame:
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)), F.col(text).cast("string").alias("text"))

    def run(stream):
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in stream:
            for part in slices(batch, size=BATCH_BYTES // 8):
                held.append(part)
                size += part.nbytes
                if size >= BATCH_BYTES:
                    yield _batch(number, held)
                    number, held, size = number + 1, [], 0
        if held:
            yield _batch(number, held)

    return stored(rows.mapInArrow(
        run, "batch bigint, codes binary, words array<struct<lang:string,word:string,n:bigint>>, "
             "totals array<struct<lang:string,n:bigint>>"), "word-batches")


def _frequent_words(batches: DataFrame, least: int) -> DataFrame:
    """lang, word, f and a gapless id, for words found at least `least` times."""
    counted = batches.select(F.explode("words").alias("w")).groupBy("w.lang", "w.word").agg(F.sum("w.n").alias("f"))
    return stored(global_position(counted.where(F.col("f") >= least), "lang", "word", name="id"), "frequent-words")


def _ngrams(batches: DataFrame, words: DataFrame, width: int, bits: int, least: int) -> DataFrame:
    """n, ids a, b, c (null for pairs) and f of the pairs and triples found at least `least` times."""
    asked = batches.select("batch", F.posexplode("words").alias("at", "w")).select("batch", "at", "w.lang", "w.word")
    told = lookup_join(asked, words.select("lang", "word", "id"), ["lang", "word"], "inner").groupBy("batch").agg(
        F.collect_list(F.struct("at", "id")).alias("ids"))
    rows = batches.select("batch", "codes", F.size("words").alias("known")).join(told, "batch")
    shapes = {n: Shape(n, width) for n in (2, 3)}

    def count(stream):
        for batch in stream:
            for row in range(batch.num_rows):
                yield _counted(batch.slice(row, 1), shapes, bits)

    def merge(key: tuple, pieces: pa.Table) -> pa.Table:
        n, part = key[0].as_py(), key[1].as_py()
        found = CountingFilter.merged([
            CountingFilter.from_bytes(p, shapes[n], part) for p in pieces.column("payload").to_pylist()]).at_least(least)
        ids, counts = found.items()
        return pa.table({
            "n": pa.array([n] * len(counts), pa.int32()), "a": ids[0], "b": ids[1],
            "c": ids[2] if n == 3 else pa.nulls(len(counts), pa.int64()), "f": counts})

    pieces = rows.mapInArrow(count, "n int, part bigint, payload binary")
    return stored(pieces.groupBy("n", "part").applyInArrow(merge, "n int, a bigint, b bigint, c bigint, f bigint"), "ngrams")


def _counted(row: pa.RecordBatch, shapes: dict[int, Shape], bits: int) -> pa.RecordBatch:
    """The filters of one batch, a row for each range of quotients that is not empty."""
    told = row.column("ids").flatten()
    ids = np.full(row.column("known")[0].as_py(), -1, np.int64)
    ids[told.field("at").to_numpy()] = told.field("id").to_numpy()
    codes = np.frombuffer(zstandard.ZstdDecompressor().decompress(row.column("codes")[0].as_py()), "<i8")
    word, follows = ids[codes >> 1], codes & 1 == 0
    both = (word[:-1] >= 0) & (word[1:] >= 0) & follows[1:]
    out: list[tuple[int, int, bytes]] = []
    for n, shape in shapes.items():
        at = np.flatnonzero(both if n == 2 else both[:-1] & both[1:])
        top = min(bits, shape.high)
        found = CountingFilter.of(shape, *[word[at + k] for k in range(n)])
        out += [(n, part, piece.to_bytes(top)) for part, piece in found.split(top)]
    return pa.RecordBatch.from_arrays(
        [pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int64()),
         pa.array([o[2] for o in out], pa.binary())], ["n", "part", "payload"])


def cut_score(whole: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (l * r)), exact for counts below 10^15."""
    a, left, right = (c.cast("decimal(15,0)") for c in (whole, left, right))
    scaled = (a * a * F.lit(_SCALE).cast("decimal(7,0)")).cast("decimal(38,0)")
    return F.call_function("div", scaled, (left * right).cast("decimal(38,0)"))


def collocations(docs: DataFrame, least: int = 10, inside_percent: int = 50, top: int = 2_000,
                 lang: str = "lang", text: str = "text") -> DataFrame:
    """The best phrases of two and three words of each language: lang, rank, phrase, a, l, r, n and score.

    A text is cut into pieces at `.,;:!?` and line ends and those into words
    at spaces and tabs, A-Z in lower case; phrases lie inside a piece and are found at least
    `least` times (a).  A phrase is cut where it scores lowest, of equal cuts
    the first: l and r are the counts of its two sides, n the words of the
    language.  A pair inside a triple that makes up `inside_percent` of it or
    more is dropped.  Kept are the first `top` by score, count and phrase.

    Null texts count as empty, a null language as `und`; repeated rows count
    as often as they are there, ids are not read, and an empty table gives no
    rows.  A task holds one batch of text; a longer text is a batch of its own
    and is read in portions cut behind words.
    """
    batches = _batches(docs, lang, text)
    totals = batches.select(F.explode("totals").alias("t")).groupBy("t.lang").agg(F.sum("t.n").alias("n"))
    words = _frequent_words(batches, least)
    sizes = words.agg(F.count(F.lit(1))).scalar().alias("distinct"), totals.agg(F.sum("n")).scalar().alias("all")
    size = docs.sparkSession.range(1).select(*sizes).first()
    width = max((size["distinct"] - 1).bit_length(), 1)
    if width > WIDEST:
        raise ValueError(f"more than 2^{WIDEST} frequent words")
    bits = max((size["all"] or 0) // PART_WORDS, 3).bit_length()
    grams = _ngrams(batches, words, width, bits, least)

    word = words.select(F.col("id"), "lang", "word", F.col("f"))
    pairs = grams.where("n = 2").select("a", "b", "f")
    triples = grams.where("n = 3").select("a", "b", "c", "f")

    def with_words(rows: DataFrame, column: str) -> DataFrame:
        own = word.select(F.col("id").alias(column), F.col("word").alias(f"{column}_word"), F.col("f").alias(f"{column}_f"),
                          *([F.col("lang")] if column == "a" else []))
        return lookup_join(rows, own, [column], "inner")

    def with_pair(rows: DataFrame, first: str, second: str, name: str) -> DataFrame:
        own = pairs.select(F.col("a").alias(first), F.col("b").alias(second), F.col("f").alias(name))
        return lookup_join(rows, own, [first, second], "inner")

    longer = triples.select("a", "b", F.col("f").alias("longer")).unionByName(
        triples.select(F.col("b").alias("a"), F.col("c").alias("b"), F.col("f").alias("longer"))
    ).groupBy("a", "b").agg(F.max("longer").alias("longer"))
    # Stored step by step: one plan of all these joins would fill the driver.
    free = stored(lookup_join(pairs, longer, ["a", "b"], "left").where(
        F.coalesce(100 * F.col("longer") < inside_percent * F.col("f"), F.lit(True))), "free-pairs")
    two = with_words(with_words(free, "a"), "b").select(
        "lang", F.concat_ws(" ", "a_word", "b_word").alias("phrase"), F.col("f").alias("a"),
        F.col("a_f").alias("l"), F.col("b_f").alias("r"), cut_score(F.col("f"), F.col("a_f"), F.col("b_f")).alias("score"))

    three = stored(with_pair(with_pair(triples, "a", "b", "ab_f"), "b", "c", "bc_f"), "triples")
    for name in ("a", "b", "c"):
        three = with_words(three, name)
    first = cut_score(F.col("f"), F.col("a_f"), F.col("bc_f"))
    second = cut_score(F.col("f"), F.col("ab_f"), F.col("c_f"))
    three = three.withColumns({"first": first, "second": second})
    early = F.col("first") <= F.col("second")
    three = three.select(
        "lang", F.concat_ws(" ", "a_word", "b_word", "c_word").alias("phrase"), F.col("f").alias("a"),
        F.when(early, F.col("a_f")).otherwise(F.col("ab_f")).alias("l"),
        F.when(early, F.col("bc_f")).otherwise(F.col("c_f")).alias("r"), F.least("first", "second").alias("score"))

    scored = [_first(stored(x, "phrases").withColumn("deal", _deal(docs)), top, "lang", "deal") for x in (two, three)]
    best = _first(scored[0].unionByName(scored[1]), top, "lang")
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _deal(docs: DataFrame) -> Column:
    """Deals the phrases of a language out, to as many tasks as the square root of all."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return F.pmod(F.xxhash64("phrase"), F.lit(max(round(parts ** 0.5), 1)))


def _first(phrases: DataFrame, top: int, *by: str) -> DataFrame:
    """The first `top` of each group, with their rank; every task sends no more than that of a group."""
    place = F.row_number().over(W.partitionBy(*by).orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return phrases.withColumn("rank", place.cast("long")).where(F.col("rank") <= top)
