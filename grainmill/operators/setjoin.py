"""Similarity joins of word sets without nested loops and without a hot key.

Sets with similarity >= t share one of their first words under any fixed order of all words (prefix
filter), and the place of the first word that they share bounds how much they can share (positional
filter). The order is rare words first by a count sketch of fixed size, held by every task, so words
don't travel to meet their frequency. A second sketch counts the rows that a word brings together:
a row without a partner is not written, and rows of frequent words are cut into cells of a range of
set sizes and a salt, bounded on both sides, without a join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The most counters of a word sketch (32 bits each), whatever the data. Words that share a counter share its count.
SKETCH = 1 << 22
#: Parts over which rows of one text are spread.
PARTS = 32
#: Bits of a set's folded vector.
BITS = 128
#: Lower bounds of the ranges of set sizes, 10 % apart.
RANGES = np.unique(np.floor(1.1 ** np.arange(250)))
#: Rows of the larger sets that a cell takes for each of the smaller ones.
WIDE = 8
#: Rows of a block up to which all such blocks of a batch are compared together.
SMALL = 48


def sketch_width(n_sets: int) -> int:
    """Counters for so many sets: about 32 per set, at most SKETCH."""
    return min(SKETCH, 1 << (32 * n_sets + 1024).bit_length())


def sketch(rows: DataFrame, width: int, most: int = 2**31 - 1) -> np.ndarray:
    """``width`` counters: sums of column ``n`` by column ``i``, at most ``most``.

    Tasks pack their counters into two byte strings a batch and the driver takes one part after the other,
    so it holds no row per counter, whether Arrow is on in the session or not.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.column(k).to_numpy().tobytes()], pa.binary()) for k in ("i", "n")], names=["i", "n"])

    got = rows.groupBy("i").agg(F.least(F.sum("n"), F.lit(most)).cast("int").alias("n"))
    out = np.zeros(width, np.int32)
    for r in got.mapInArrow(pack, "i binary, n binary").toLocalIterator():
        out[np.frombuffer(r["i"], np.int32)] = np.frombuffer(r["n"], np.int32)
    return out


def sent(spark: SparkSession, counters: np.ndarray):
    """A broadcast of counters, compressed: every executor keeps what it is sent on disk for its Python workers, and most counters are small."""
    raw = np.ascontiguousarray(counters, np.int32).tobytes()
    return spark.sparkContext.broadcast((pa.compress(raw, "zstd", asbytes=True), len(raw)))


def held(counters) -> np.ndarray:
    """The counters of a broadcast made by ``sent``."""
    packed, n = counters.value
    return np.frombuffer(pa.decompress(packed, n, "zstd", asbytes=True), np.int32)


def place(x: Column | str, width: int) -> Column:
    """The counter of a value among ``width``."""
    return F.pmod(F.xxhash64(x), F.lit(width)).cast("int")


def word_counts(words: DataFrame, width: int = SKETCH) -> np.ndarray:
    """The count sketch of a column ``w`` of words: counters by hash, at most ``width`` whatever the data."""
    return sketch(words.select(place("w", width).alias("i"), F.lit(1).alias("n")), width)


def _tally(i: np.ndarray) -> pa.RecordBatch:
    at, n = np.unique(i, return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n.astype(np.int64))], names=["i", "n"])


def _ragged(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    off = column.offsets.to_numpy()
    return column.values.to_numpy()[off[0] : off[-1]], (off - off[0]).astype(np.int64)


def word_and_copy_counts(rows: DataFrame, width: int) -> np.ndarray:
    """Two sketches, one after the other, in one pass over ``hashes`` (of a row's words) and ``copy`` (a hash equal in copies): of words, of copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _tally(np.concatenate([_ragged(b.column("hashes"))[0] % width, b.column("copy").to_numpy() % width + width]))

    return sketch(rows.select("hashes", "copy").mapInArrow(run, "i int, n long"), 2 * width)


def where_counted(df: DataFrame, at: Column, counts, least: int, most: int = 2**31 - 1) -> DataFrame:
    """Rows whose counter, at the index ``at`` of a sketch that was sent, lies within the bounds. A counter may be too high, never too low."""
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = held(counts)
        for b in batches:
            n = counters[b.column("_at").to_numpy()]
            yield b.select(names).filter(pa.array((n >= least) & (n <= most)))

    return df.withColumn("_at", at).mapInArrow(run, df.schema)


def prefixes(values: np.ndarray, offsets: np.ndarray, counts: np.ndarray, t: float, least: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, their counts, rows, reach): of each row the first n - ceil(t n) + 1 words, rare ones first, without those counted below ``least``.

    Reach is the greatest size of a set that has similarity >= t with the row if this word is the first that they share.
    """
    size = np.diff(offsets)
    row = np.repeat(np.arange(len(size)), size)
    n = counts[values % len(counts)]  # a floor modulus, as pmod
    order = np.lexsort((values, n, row))
    values, n = values[order], n[order]
    keep = size - np.ceil(size * t - 1e-9).astype(np.int64) + 1
    at = np.arange(len(values)) - offsets[:-1][row]
    reach = np.floor((size[row] - at) * (1 + t) / t - size[row] + 1e-6).astype(np.int32)
    first = (at < keep[row]) & (n >= least) & (reach >= size[row] * t - 1e-9)
    return values[first], n[first], row[first], reach[first]


def fold(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bit vectors (rows x BITS/64) of ragged hash arrays: the exclusive-or of each row's word bits."""
    sig = np.zeros((len(offsets) - 1, BITS // 64), np.uint64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    bit = values.view(np.uint64) % np.uint64(BITS)
    np.bitwise_xor.at(sig, (row, (bit >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (bit & np.uint64(63)))
    return sig


def tile_pairs(sig: np.ndarray, size: np.ndarray, left: np.ndarray, right: np.ndarray, t: float, tile: int = 256, reach: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i of left, j of right) within the radius and each other's reach; both sides sorted by size. ``left is right`` compares i < j."""
    same = left is right
    r = (1 - t) / (1 + t)
    for a in range(0, len(left), tile):
        i = left[a : a + tile]
        for b in range(a if same else 0, len(right), tile):
            j = right[b : b + tile]
            if size[j[0]] * t > size[i[-1]] + 1e-9 or size[i[0]] * t > size[j[-1]] + 1e-9:
                continue  # population counts differ beyond the radius
            apart = np.bitwise_count(sig[i][:, None, :] ^ sig[j][None, :, :]).sum(axis=2, dtype=np.int32)
            ok = apart <= r * (size[i][:, None] + size[j][None, :]) + 1e-9
            if reach is not None:
                ok &= (size[j][None, :] <= reach[i][:, None]) & (size[i][:, None] <= reach[j][None, :])
            if same and a == b:
                ok &= np.triu(np.ones_like(ok), 1)
            x, y = np.nonzero(ok)
            if len(x):
                yield i[x], j[y]


def near_pairs(sig: np.ndarray, size: np.ndarray, side: np.ndarray, length: np.ndarray, t: float, across: bool = False, reach: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs within the radius (and each other's reach) of all blocks of at most SMALL rows, blocks lying one after the other: all rows are compared with
    the d-th row after them, for d = 1, 2, …, in one exclusive-or each. Blocks of both sides compare across them only, and with ``across`` all do."""
    if not len(side):
        return
    start = np.cumsum(length) - length
    two = np.repeat(across | (np.add.reduceat(side, start) > 0), length)
    left = np.repeat(np.where(length <= SMALL, length, 0), length) - (np.arange(len(size)) - np.repeat(start, length))  # rows from here to the block's end
    r = (1 - t) / (1 + t)
    i = np.flatnonzero(left > 1)
    d = 1
    while len(i):
        j = i + d
        fit = (size[i] >= size[j] * t - 1e-9) & (size[j] >= size[i] * t - 1e-9) & (~two[i] | (side[i] != side[j]))
        if reach is not None:
            fit &= (size[j] <= reach[i]) & (size[i] <= reach[j])
        x, y = i[fit], j[fit]
        apart = np.bitwise_count(sig[x] ^ sig[y]).sum(axis=1, dtype=np.int32)
        ok = apart <= r * (size[x] + size[y]) + 1e-9
        yield x[ok], y[ok]
        d += 1
        i = i[left[i] > d]


def _mixed(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    """64-bit keys of pairs of integers."""
    x = (np.atleast_1d(a).astype(np.uint64) ^ (np.atleast_1d(b).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


def _times(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, 0 … n - 1) of every position repeated n times."""
    at = np.repeat(np.arange(len(n)), n)
    return at, np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)


def _seats(values: np.ndarray, offsets: np.ndarray, side: np.ndarray, counts: np.ndarray, t: float, tile: int, across: bool) -> dict[str, np.ndarray]:
    """Where a row looks for partners: row, reach, key, small, hot, need.

    Of any pair the smaller set (or either, if equal) reaches beyond its own size: it takes a small seat. A word that may exceed
    ``tile`` rows is cut by ranges of the smaller set's size; every row takes a large seat in each range within its reach.
    ``need``: rows on the other side (or the same one) without which a seat is of no use, the row itself counted if it is there.
    """
    size = np.diff(offsets)
    token, n, row, reach = prefixes(values, offsets, counts, t)
    small, hot = reach >= size[row], n > tile
    own = np.searchsorted(RANGES, size[row], "right")
    key = token.view(np.uint64) & ~np.uint64(1)  # never a key of a cell
    out = [(row[~hot], reach[~hot], key[~hot], small[~hot], np.where(small[~hot] & (not across), 2, 1))]
    a = np.flatnonzero(hot & small)
    out.append((row[a], reach[a], _mixed(token[a], own[a]) | np.uint64(1), np.ones(len(a), bool), np.full(len(a), 1 if across else 2)))
    a = np.flatnonzero(hot)
    low = np.searchsorted(RANGES, np.maximum(np.ceil(size[row[a]] * t - 1e-9), 1), "right")
    high = np.searchsorted(RANGES, np.minimum(reach[a], size[row[a]]), "right")
    at, k = _times(high - low + 1)
    a, k = a[at], low[at] + k
    out.append((row[a], reach[a], _mixed(token[a], k) | np.uint64(1), np.zeros(len(a), bool), np.where(small[a] & (k == own[a]) & (not across), 2, 1)))
    got = {k: np.concatenate(v) for k, v in zip(("row", "reach", "key", "small", "need"), zip(*out))}
    return got | {"side": side[got["row"]], "hot": np.arange(len(got["row"])) >= len(out[0][0])}


def _counter(key: np.ndarray, side: np.ndarray, small: np.ndarray, width: int) -> np.ndarray:
    return ((side * 2 + small) * width + (key % np.uint64(width)).astype(np.int64)).astype(np.int64)


def _count_seats(counts, words: int, width: int, t: float, tile: int, across: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency = held(counts)[:words]
        for b in batches:
            s = _seats(*_ragged(b.column("hashes")), b.column("side").to_numpy().astype(np.int64), frequency, t, tile, across)
            yield _tally(_counter(s["key"], s["side"], s["small"], width))

    return run


def _block_rows(counts, words: int, seats, width: int, t: float, tile: int, across: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency, taken = held(counts)[:words], held(seats)
        for b in batches:
            values, off = _ragged(b.column("hashes"))
            rep = b.column("rep").to_numpy()
            s = _seats(values, off, b.column("side").to_numpy().astype(np.int64), frequency, t, tile, across)
            other = 1 - s["side"] if across else s["side"]
            small, large = (taken[_counter(s["key"], other, np.full(len(other), k), width)] for k in (1, 0))
            # at an uncut word all rows with small seats meet all others; in a cell small seats meet large ones
            met = np.where(s["hot"], np.where(s["small"], large, small), small + np.where(s["small"], large, 0))
            s = {k: v[met >= s["need"]] for k, v in (s | {"other": other}).items()}
            # a cell's small seats are cut into parts of `tile`, its large ones into wide parts; each part meets each
            mine = taken[_counter(s["key"], s["side"], s["small"], width)]
            theirs = taken[_counter(s["key"], s["other"], ~s["small"], width)]
            parts = lambda n, small: np.where(s["hot"], -(-n // np.where(small, tile, WIDE * tile)), 1).astype(np.int64)
            own, rest = parts(mine, s["small"]), parts(theirs, ~s["small"])
            salt = (_mixed(rep[s["row"]].view(np.uint64), 7) % own.astype(np.uint64)).astype(np.int64)
            at, k = _times(rest)
            s, salt = {n: v[at] for n, v in s.items()}, salt[at]
            first = np.where(s["small"], s["side"], s["other"])  # the side of the small seats
            cell = np.where(s["small"], salt, k) * 2 + first
            block = np.where(s["hot"], _mixed(_mixed(s["key"], cell), np.where(s["small"], k, salt)) | np.uint64(1), s["key"])
            place = s["side"] if across else (s["hot"] & ~s["small"]).astype(np.int64)
            bits = fold(values, off)[s["row"]]
            bits = pa.Array.from_buffers(pa.binary(BITS // 8), len(bits), [None, pa.py_buffer(np.ascontiguousarray(bits).tobytes())]).cast(pa.binary())
            cols = [pa.array(block.view(np.int64)), pa.array(place.astype(np.int32)), pa.array(rep[s["row"]]), pa.array(np.diff(off)[s["row"]].astype(np.int32)), pa.array(s["reach"]), bits]
            yield pa.RecordBatch.from_arrays(cols, names=["block", "side", "rep", "size", "reach", "bits"])

    return run


def _compare(t: float, across: bool):
    def emit(tab: pa.Table) -> Iterator[pa.RecordBatch]:
        block, side, rep, size, reach = (tab.column(k).to_numpy() for k in ("block", "side", "rep", "size", "reach"))
        bits = tab.column("bits").combine_chunks().cast(pa.binary(BITS // 8))
        sig = np.frombuffer(bits.buffers()[1], np.uint64, len(bits) * BITS // 64, bits.offset * BITS // 8).reshape(-1, BITS // 64)
        cut = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]]))
        length = np.diff(cut)
        xs, ys = [], []
        for x, y in near_pairs(sig, size, side, length, t, across, reach):
            xs.append(x)
            ys.append(y)
        for b in np.flatnonzero(length > SMALL).tolist():
            s, e = cut[b], cut[b + 1]
            at = np.arange(s, e)
            at = at[np.argsort(size[s:e], kind="stable")]
            if not across and (side[s:e] == 0).all():
                found = tile_pairs(sig, size, at, at, t, reach=reach)
            else:
                found = tile_pairs(sig, size, at[side[at] == 0], at[side[at] == 1], t, reach=reach)
            for x, y in found:
                xs.append(x)
                ys.append(y)
        if xs:
            x, y = np.concatenate(xs), np.concatenate(ys)
            apart = across | (rep[x] != rep[y])  # a row may have both seats of a cell
            x, y = x[apart], y[apart]
            turn = side[x] > side[y] if across else rep[x] > rep[y]
            yield pa.RecordBatch.from_arrays([pa.array(rep[np.where(turn, y, x)]), pa.array(rep[np.where(turn, x, y)])], names=["rep_a", "rep_b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for b in batches:
            if not b.num_rows:
                continue
            tab = pa.Table.from_batches([b])
            tab = pa.concat_tables([held, tab]) if held is not None else tab
            block = tab.column("block").to_numpy()
            other = np.flatnonzero(block != block[-1])
            n = int(other[-1]) + 1 if len(other) else 0
            if n:
                yield from emit(tab.slice(0, n))
            held = tab.slice(n)
        if held is not None:
            yield from emit(held)

    return run


def near_sets(a: DataFrame, b: DataFrame | None, counts, t: float, tile: int = 2048) -> DataFrame:
    """rep_a, rep_b: distinct pairs of sets of ``a`` and ``b`` (or within ``a``, rep_a < rep_b) that share a prefix word and pass the bit test.

    ``a``, ``b``: (rep long, words). ``counts``: a sketch of the words of all sets, as ``sent``. No pair with
    similarity >= t is missing; what is listed must still be verified.
    """
    # words travel as 64-bit hashes: two words that met in one would only share a block, never lose a pair
    hashed = lambda d, side: d.select("rep", F.lit(side).alias("side"), hashes("words").alias("hashes"))
    rows = hashed(a, 0).unionByName(hashed(b, 1)) if b is not None else hashed(a, 0)
    return near_rows(rows, counts, counts.value[1] // 4, t, b is not None, tile)


def hashes(words: Column | str) -> Column:
    return F.transform(words, lambda x: F.xxhash64(x))


def near_rows(rows: DataFrame, counts, words: int, t: float, across: bool, tile: int = 2048) -> DataFrame:
    """The pairs of near_sets for rows (rep long, side int, hashes), read twice: of side 0 and side 1 if ``across``. The sketch's first ``words`` counters are those of words."""
    rows = rows.select("rep", "side", "hashes").where(F.size("hashes") > 0)
    width = max(words // 2, 1024)
    found = sketch(rows.mapInArrow(_count_seats(counts, words, width, t, tile, across), "i int, n long"), (4 if across else 2) * width)
    seats = sent(rows.sparkSession, found)
    blocks = rows.mapInArrow(_block_rows(counts, words, seats, width, t, tile, across), "block long, side int, rep long, size int, reach int, bits binary")
    blocks = blocks.repartition("block").sortWithinPartitions("block")
    return blocks.mapInArrow(_compare(t, across), "rep_a long, rep_b long").distinct()
