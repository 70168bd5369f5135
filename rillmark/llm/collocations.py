"""Collocations: frequent phrases whose weakest cut still binds, per language.

Phrases are counted by multikey three-way quicksort of suffix pointers. A suffix is a word
with up to ``depth - 1`` words behind it in its piece. Suffixes are routed by their leading
words: a total order (hashes of language and words, place by place) is cut into ranges of
about equal numbers of words, found on a sample, so a hot word or word pair spreads over as
many ranges as it fills, and only equal suffixes, which are summed before the shuffle, can
not be parted. In a range, pointers are split by their word at one depth into less, equal
and greater; the weight of an equal part is the count of its prefix, and parts lighter than
the threshold are abandoned. Prefixes of the cuts between ranges may lie in several of
them; these are counted in each whatever their weight, and summed at the end.

Before that a pass counts words by slots of a hash table of fixed size; a word whose slot is
below the threshold is in no frequent phrase, and suffixes end before it. Slots shared by
several words let more pass, never less, so the table only saves work.

All counts of parts of a frequent phrase are counts of frequent phrases, so scores come from
joins of the counted phrases; products are decimals.

Defined results: a null text is empty, a null lang is `und`; repeated rows count again; an
empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillmark.functions.lookup import lookup_join
from rillmark.llm.frames import forget, row_chunks, stored, text_column

DEPTH = 5
LEAST = 100
TOP = 2000
#: Slots of the table of word counts.
SLOT_BITS = 23
#: Words whose suffixes make up a range, and the share of words that the cuts are found on.
RANGE_WORDS = 1_500_000
SAMPLE_SHARE = 1 / 20_000
#: Most sampled suffixes that the driver sorts (24 bytes each); beyond that the sample is thinned.
SAMPLE_MOST = 2_000_000
#: Bytes of text whose words a worker sorts at once, and bytes of suffixes it copies at once.
BATCH, COPIED = 4 << 20, 1 << 20
SHARDS = 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CUTS = np.zeros(256, bool)
_CUTS[[ord(c) for c in ".,;:!?"] + [10, 11, 12, 13]] = True
_INSIDE = ~_CUTS
_INSIDE[[0x20, 0x09]] = False


class Words:
    """Words of texts: ``codes`` into ``unique`` (bytes), and the piece and row of each."""

    def __init__(self, texts: pa.Array):
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        ends = ends - ends[0]
        data = _LOWER[data]
        inside = _INSIDE[data]
        opens = np.zeros(len(data), bool)
        opens[ends[:-1][ends[:-1] < len(data)]] = True
        starts = np.flatnonzero(inside & (opens | ~np.concatenate([[False], inside[:-1]])))
        stops = np.flatnonzero(inside & np.concatenate([opens[1:] | ~inside[1:], [True]])) + 1
        self.piece = np.cumsum(_CUTS[data] | opens, dtype=np.int64)[starts]
        self.row = np.searchsorted(ends, starts, "right") - 1
        self.codes, self.unique = coded(data, starts, stops)

    def __len__(self) -> int:
        return len(self.codes)


def coded(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Number of each span of ``data`` among the distinct ones, and these."""
    if not len(starts):
        return np.zeros(0, np.int64), []
    offsets = np.column_stack([starts, stops]).astype(np.int64).ravel()
    spans = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
    found = spans.take(pa.array(np.arange(0, len(offsets) - 1, 2))).dictionary_encode()
    return found.indices.to_numpy(), found.dictionary.to_pylist()


def hashes(words: list[bytes]) -> np.ndarray:
    """32-bit hashes; 0 is left for no word."""
    return np.maximum(np.fromiter(map(zlib.crc32, words), np.uint32, len(words)), 1)


def slots(lang: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Slot of each word (hashes of language and word)."""
    mixed = (word.astype(np.uint64) | (lang.astype(np.uint64) << np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def keys(lang: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """Hashes of language and words as byte strings that compare like the tuples."""
    table = np.column_stack([lang, *words]).astype(">u4")
    return np.ascontiguousarray(table).view(f"S{4 * table.shape[1]}").ravel()


def _languages(batch: pa.RecordBatch) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct languages of a batch, their hashes, and the number of the language of each row."""
    found = batch.column("lang").dictionary_encode()
    names = found.dictionary.to_pylist()
    return names, hashes([x.encode() for x in names]), found.indices.to_numpy()


def _follow(words: Words, inside: np.ndarray, depth: int) -> np.ndarray:
    """For each word the number of words of its suffix: up to ``depth``, in its piece, all ``inside``."""
    n = len(words)
    breaks = ~inside
    breaks[1:] |= words.piece[1:] != words.piece[:-1]
    at = np.append(np.flatnonzero(breaks), n)
    here = np.arange(n)
    return np.minimum(at[np.searchsorted(at, here, "right").clip(max=len(at) - 1)] - here, depth) * inside


def counted_words(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """One pass over ``docs`` (lang, text): rows ``lang`` (lang, n), ``slot`` (slot, n) and ``key`` (key, chance), stored."""
    schema = pa.schema([("kind", pa.string()), ("lang", pa.string()), ("slot", pa.int32()), ("n", pa.int64()), ("key", pa.binary()), ("chance", pa.float64())])

    def rows(kind: str, count: int, **columns) -> pa.RecordBatch:
        given = {"kind": pa.array([kind] * count, pa.string())} | columns
        return pa.RecordBatch.from_arrays([given.get(f.name, pa.nulls(count, f.type)).cast(f.type) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << SLOT_BITS, np.uint32)
        totals: dict[str, int] = {}
        rng = np.random.default_rng(TaskContext.get().partitionId())
        for batch in row_chunks(batches, "text", BATCH):
            words = Words(text_column(batch.column("text")))
            if not len(words):
                continue
            names, lang_hash, lang = _languages(batch)
            lang = lang[words.row]
            for k, n in enumerate(np.bincount(lang, minlength=len(names))):
                totals[names[k]] = totals.get(names[k], 0) + int(n)
            # words are counted by (language, word) first: a batch has few of the former and each word often
            pairs, n = np.unique(words.codes.astype(np.int64) * len(names) + lang, return_counts=True)
            word_hash = hashes(words.unique)
            np.add.at(table, slots(lang_hash[pairs % len(names)], word_hash[pairs // len(names)]), n.astype(np.uint32))
            chance = rng.random(len(words))
            some = np.flatnonzero(chance < SAMPLE_SHARE)
            long = _follow(words, np.ones(len(words), bool), depth)[some]
            code = [np.where(long > d, word_hash[words.codes[np.minimum(some + d, len(words) - 1)]], 0) for d in range(depth)]
            made = [x.ljust(4 * depth + 4, b"\0") for x in keys(lang_hash[lang[some]], code).tolist()]
            yield rows("key", len(some), key=pa.array(made, pa.binary()), chance=pa.array(chance[some]))
        yield rows("lang", len(totals), lang=pa.array(list(totals), pa.string()), n=pa.array(list(totals.values()), pa.int64()))
        full = np.flatnonzero(table)
        for a in range(0, len(full), 1 << 17):
            part = full[a : a + (1 << 17)]
            yield rows("slot", len(part), slot=pa.array(part.astype(np.int32)), n=pa.array(table[part].astype(np.int64)))

    return stored(docs.mapInArrow(run, "kind string, lang string, slot int, n bigint, key binary, chance double"), "collocation-words")


def frequent_slots(counted: DataFrame, least: int) -> np.ndarray:
    """A flag per slot of the table: may hold a word with ``least`` occurrences. 1 MB, whatever the corpus."""
    full = counted.where("kind = 'slot'").groupBy("slot").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select((F.col("slot") + 1).cast("bigint").alias("s"))
    maps = full.groupBy(F.bitmap_bucket_number("s").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("bits"))
    out = np.zeros(1 << SLOT_BITS, bool)
    for r in maps.collect():  # at most one row of 4 kB per 32,768 slots
        bits = np.unpackbits(np.frombuffer(bytes(r["bits"]), np.uint8), bitorder="little")
        first = (r["bucket"] - 1) * len(bits)
        out[first : first + len(bits)] = bits[: len(out) - first]
    return out


def cuts(counted: DataFrame, words: int, range_words: int) -> list[bytes]:
    """Keys between the ranges, ascending, all different: quantiles of a sample of all suffixes."""
    ranges = -(-words // range_words)
    if ranges < 2:
        return []
    share = min(SAMPLE_SHARE, SAMPLE_MOST / words)
    sample = sorted(bytes(r["key"]) for r in counted.where((F.col("kind") == "key") & (F.col("chance") < share)).select("key").collect())
    return sorted({sample[len(sample) * k // ranges] for k in range(1, ranges)}) if sample else []


def routed(docs: DataFrame, frequent: np.ndarray, between: list[bytes], depth: int) -> DataFrame:
    """(part, lang, bytes, n, suffixes, weights): suffixes of a batch for a range, each text with a line feed behind it; equal ones once, with their number.

    Neighbours share their first words, so both columns are compressed before the shuffle.
    """
    packed = np.packbits(frequent)
    width = 4 * depth + 4
    bounds = np.array(between, f"S{width}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = np.unpackbits(packed).astype(bool)
        for batch in row_chunks(batches, "text", BATCH):
            words = Words(text_column(batch.column("text")))
            if not len(words):
                continue
            names, lang_hash, lang = _languages(batch)
            lang = lang[words.row]
            word_hash = hashes(words.unique)
            long = _follow(words, passes[slots(lang_hash[lang], word_hash[words.codes])], depth)
            at = np.flatnonzero(long)
            if not len(at):
                continue
            # equal suffixes become neighbours; words are numbered by hash, so nearly in the order of the ranges
            rank = np.empty(len(words.unique), np.int32)
            rank[np.argsort(word_hash, kind="stable")] = np.arange(1, len(rank) + 1, dtype=np.int32)
            columns = [np.where(long[at] > d, rank[words.codes[np.minimum(at + d, len(words) - 1)]], 0) for d in range(depth)]
            order = np.lexsort([*columns[::-1], lang[at]])
            new = np.zeros(len(at), bool)
            new[0] = True
            for c in [lang[at], *columns]:
                c = c[order]
                new[1:] |= c[1:] != c[:-1]
            first = np.flatnonzero(new)
            weight = np.diff(np.append(first, len(at))).astype("<u4")
            at = at[order[first]]
            code = [np.where(long[at] > d, word_hash[words.codes[np.minimum(at + d, len(words) - 1)]], 0) for d in range(depth)]
            part = np.searchsorted(bounds, keys(lang_hash[lang[at]], code), "right") if len(bounds) else np.zeros(len(at), np.int64)
            order = np.lexsort([lang[at], part])
            at, part, weight, lang_at = at[order], part[order], weight[order], lang[at][order]
            # all words with a blank behind each; a suffix is one span of it
            spaced = pa.array([w + b" " for w in words.unique], pa.large_binary()).take(pa.array(words.codes))
            offsets = np.frombuffer(spaced.buffers()[1], np.int64)[: len(words) + 1]
            text = np.frombuffer(spaced.buffers()[2], np.uint8)
            behind = np.concatenate([[0], np.cumsum(offsets[at + long[at]] - offsets[at])])
            out = spans(text, offsets[at], behind)
            out[behind[1:] - 1] = 10
            edge = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (lang_at[1:] != lang_at[:-1])]))
            ends = np.append(edge[1:], len(at))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part[edge].astype(np.int32)), pa.array([names[k] for k in lang_at[edge]], pa.string()),
                    pa.array((behind[ends] - behind[edge]).astype(np.int64)), pa.array((ends - edge).astype(np.int64)),
                    pa.array([pa.compress(out[behind[a] : behind[b]], "zstd", asbytes=True) for a, b in zip(edge, ends)], pa.binary()),
                    pa.array([pa.compress(weight[a:b], "zstd", asbytes=True) for a, b in zip(edge, ends)], pa.binary()),
                ],
                names=["part", "lang", "bytes", "n", "suffixes", "weights"],
            )

    return docs.mapInArrow(run, "part int, lang string, bytes bigint, n bigint, suffixes binary, weights binary")


def spans(data: np.ndarray, starts: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """Spans of ``data`` one after the other; span k fills ``behind[k]`` to ``behind[k + 1]``."""
    out = np.empty(behind[-1], np.uint8)
    edges = np.searchsorted(behind, np.arange(0, behind[-1] + COPIED, COPIED)).clip(max=len(behind) - 1)
    for a, b in zip(edges, edges[1:]):
        if a < b:
            out[behind[a] : behind[b]] = data[np.repeat(starts[a:b] - behind[a:b], np.diff(behind[a : b + 1])) + np.arange(behind[a], behind[b])]
    return out


def heavy_prefixes(columns: list[np.ndarray], weights: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(pointer, depth, weight) of every prefix of at least ``least`` weight, by multikey three-way quicksort.

    ``columns[d]`` has the word of each suffix at depth ``d``, 0 where it has ended. Parts
    below ``least`` are dropped unsorted; a part that has run to the last column is done.
    """
    parts = [(np.arange(len(weights)), 0)]
    while parts:
        pointers, depth = parts.pop()
        word = columns[depth][pointers]
        pivot = np.sort(word[[0, len(word) // 2, -1]])[1]
        weight = weights[pointers]
        for side in (word < pivot, word > pivot):
            if weight[side].sum() >= least:
                parts.append((pointers[side], depth))
        equal = word == pivot
        total = int(weight[equal].sum())
        if pivot and total >= least:
            pointers = pointers[equal]
            yield int(pointers[0]), depth + 1, total
            if depth + 1 < len(columns):
                parts.append((pointers, depth + 1))


def on_the_cut(columns: list[np.ndarray], weights: np.ndarray, word_hash: np.ndarray, cut: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(pointer, depth, weight) of every prefix whose hashes are those of ``cut``, whatever its weight."""
    rows = np.arange(len(weights))
    for depth, column in enumerate(columns):
        word = column[rows]
        rows = rows[(word > 0) & (word_hash[word] == cut[depth])]
        if not len(rows) or not cut[depth]:
            return
        # words of one hash are nearly always one word
        _, first, of = np.unique(np.column_stack([c[rows] for c in columns[: depth + 1]]), axis=0, return_index=True, return_inverse=True)
        for k, total in enumerate(np.bincount(of.ravel(), weights[rows])):
            yield int(rows[first[k]]), depth + 1, int(total)


def range_counts(data: bytes, weights: np.ndarray, cuts: list[np.ndarray], least: int, depth: int) -> Iterator[tuple[bytes, int, int]]:
    """(phrase, words, count) of the suffixes of one language in one range, given the cuts on its sides."""
    text = np.frombuffer(data, np.uint8)
    blank = (text == 32) | (text == 10)
    stops = np.flatnonzero(blank)
    starts = np.concatenate([[0], stops[:-1] + 1])
    codes, unique = coded(text, starts, stops)
    last = text[stops] == 10
    suffix = np.cumsum(last) - last
    first = np.flatnonzero(np.concatenate([[True], last[:-1]]))
    columns = [np.zeros(len(weights), np.int32) for _ in range(depth)]
    place = np.arange(len(codes)) - first[suffix]
    for d in range(depth):
        here = place == d
        columns[d][suffix[here]] = codes[here] + 1
    word_hash = np.concatenate([[0], hashes(unique)])
    shared = set()

    def prefix(pointer: int, n: int) -> tuple:
        return tuple(int(columns[d][pointer]) for d in range(n))

    def phrase(words: tuple) -> bytes:
        return b" ".join(unique[w - 1] for w in words)

    for cut in cuts:
        for pointer, n, total in on_the_cut(columns, weights, word_hash, cut):
            words = prefix(pointer, n)
            if words not in shared:
                shared.add(words)
                yield phrase(words), n, total
    for pointer, n, total in heavy_prefixes(columns, weights, least):
        words = prefix(pointer, n)
        if words not in shared:
            yield phrase(words), n, total


def phrase_counts(docs: DataFrame, least: int = LEAST, depth: int = DEPTH, range_words: int = RANGE_WORDS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n_words, f) of all phrases of 1 to ``depth`` words with f >= ``least``, and (lang, n); both stored."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    counted = counted_words(texts, depth)
    totals = stored(counted.where("kind = 'lang'").groupBy("lang").agg(F.sum("n").alias("n")), "collocation-totals")
    words = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    between = cuts(counted, words, range_words)
    frequent = frequent_slots(counted, least)
    forget(counted)
    split = [np.frombuffer(k.ljust(4 * depth + 4, b"\0"), ">u4") for k in between]
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n_words", pa.int32()), ("f", pa.int64())])

    def mine(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        sides = [split[k] for k in (part - 1, part) if 0 <= k < len(split)]
        out = {f.name: [] for f in schema}
        for name in table.column("lang").unique().to_pylist():
            rows = table.filter(pc.equal(table.column("lang"), name))
            packed = zip(rows.column("weights"), rows.column("suffixes"), rows.column("n").to_pylist(), rows.column("bytes").to_pylist())
            both = [(pa.decompress(w.as_buffer(), 4 * n, "zstd"), pa.decompress(x.as_buffer(), size, "zstd")) for w, x, n, size in packed]
            weights = np.concatenate([np.frombuffer(w, "<u4") for w, _ in both]).astype(np.int64)
            data = b"".join(x for _, x in both)
            del both
            own = int(hashes([name.encode()])[0])
            for phrase, n, total in range_counts(data, weights, [c[1:] for c in sides if c[0] == own], least, depth):
                for column, value in zip(out.values(), (name, phrase.decode(), n, total)):
                    column.append(value)
        return pa.table(out, schema)

    found = routed(texts, frequent, between, depth).groupBy("part").applyInArrow(mine, "lang string, phrase string, n_words int, f bigint")
    found = found.groupBy("lang", "phrase").agg(F.max("n_words").alias("n_words"), F.sum("f").alias("f")).where(F.col("f") >= least)
    return stored(found, "collocation-phrases"), totals


def scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, n_words, k, a, l, r, n, score) of the phrases of two words or more, at their lowest cut."""
    words = F.split("phrase", " ")
    several = phrases.where("n_words > 1").withColumnRenamed("f", "a")
    each = several.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)))
    each = each.withColumns({"first": F.concat_ws(" ", F.slice(words, 1, F.col("k"))), "rest": F.concat_ws(" ", F.slice(words, F.col("k") + 1, F.col("n_words")))})
    # a frequent word opens or ends many phrases, so its key is hot
    met = lookup_join(each, phrases.selectExpr("lang", "phrase as first", "f as l"), ["lang", "first"], "inner")
    met = lookup_join(met, phrases.selectExpr("lang", "phrase as rest", "f as r"), ["lang", "rest"], "inner", keys_from=each)
    met = lookup_join(met, totals, ["lang"], "inner", keys_from=each)
    wide = "cast({} as decimal(38,0))".format
    score = F.expr(f"(1000 * ({wide('a')} * {wide('n')})) div ({wide('l')} * {wide('r')})")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("low")
    return met.groupBy("lang", "phrase", "n_words", "a", "n").agg(lowest).select("lang", "phrase", "n_words", "low.k", "a", "low.l", "low.r", "n", "low.score")


def uncovered(phrases: DataFrame, covered: int = 100) -> DataFrame:
    """(lang, phrase) of the candidates that no longer candidate with ``covered`` percent of their count contains.

    What a longer phrase contains, some phrase of one word more contains, at least as often; so these are enough.
    """
    words = F.split("phrase", " ")
    inner = F.array(F.concat_ws(" ", F.slice(words, 1, F.col("n_words") - 1)), F.concat_ws(" ", F.slice(words, 2, F.col("n_words") - 1)))
    longest = phrases.where("n_words > 2").select("lang", F.explode(inner).alias("phrase"), F.col("f").alias("longer")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    met = phrases.where("n_words > 1").join(longest, ["lang", "phrase"], "left")
    return met.where(F.coalesce(100 * F.col("longer") < covered * F.col("f"), F.lit(True))).select("lang", "phrase")


def collocations(docs: DataFrame, least: int = LEAST, depth: int = DEPTH, top: int = TOP, covered: int = 100, range_words: int = RANGE_WORDS) -> DataFrame:
    """The first ``top`` phrases of each language: (lang, rank, phrase, a, l, r, n, score, k)."""
    phrases, totals = phrase_counts(docs, least, depth, range_words)
    kept = scored(phrases, totals).join(uncovered(phrases, covered), ["lang", "phrase"])
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language may have nearly all candidates: the first of each shard, then the first of those
    shard = F.pmod(F.xxhash64("phrase"), F.lit(SHARDS))
    few = kept.withColumn("_at", F.row_number().over(Window.partitionBy("lang", shard).orderBy(*order))).where(F.col("_at") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "k")
