"""SimHash near-duplicates with bit-sliced distance comparison.

Fingerprints are linked when they differ in at most ``radius`` bits. Distinct fingerprints
are dealt to buckets by every choice of equal bands (if at most ``radius`` of ``m`` bands
can differ, ``m - radius`` bands are equal), so no link is missed. A bucket is compared in
blocks of 64: bit plane ``b`` of a block is one word holding bit ``b`` of its 64 members,
one xor with a query's bit compares 64 pairs, carry-save counters add the planes up, and a
(query, block) row is dropped as soon as every one of its lanes is over the radius.
Buckets give spanning links (member to local root), not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsmith.llm import common as C

#: A bucket of more fingerprints than this is split into shards, and pairs of shards are compared.
SHARD = 8192
#: The number of bands grows until a bucket of spread-out fingerprints has at most this many.
BUCKET = 2048
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
_TABLE = bytes(C.LOWER)


# ---------------------------------------------------------------- fingerprints

def _fingerprint(words: list[bytes], shingle: int, seed: int) -> int:
    if not words:
        return 0
    text = b" ".join(words)
    if len(words) <= shingle:
        pieces = [text]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        pieces = [text[a:b] for a, b in zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist(), strict=True)]
    h = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(seed)), np.uint64, len(pieces))
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), 1 << 14):
        ones += np.unpackbits(h[k:k + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def fingerprint(text: Column, shingle: int = 4, seed: int = 42) -> Column:
    """SimHash of the lower-cased words (``[^\\x20\\x09-\\x0D]+``) of a text, as a signed long.

    Every ``shingle``-word run counts, repeats included; fewer words are one run; no word
    (null, empty, blank) gives 0.
    """
    @F.arrow_udf("long")
    def of(col: pa.Array) -> pa.Array:
        out = np.zeros(len(col), np.uint64)
        data, off = C.text_buffer(col)
        for i in range(len(col)):
            words = data[off[i]:off[i + 1]].tobytes().translate(_TABLE).split()
            out[i] = _fingerprint(words, shingle, seed)
        return pa.array(out.view(np.int64))

    return of(text)


# ---------------------------------------------------------------- bit-sliced comparison

def planes(block: np.ndarray) -> np.ndarray:
    """(blocks, 64) fingerprints to (blocks, 64) planes: bit ``lane`` of plane ``b`` is bit ``b`` of that lane."""
    bits = np.unpackbits(block.view(np.uint8).reshape(-1, 64, 8), axis=2, bitorder="little")
    return np.packbits(bits.transpose(0, 2, 1), axis=2, bitorder="little").reshape(-1, 64, 8).copy().view(np.uint64)[:, :, 0]


def _add(a: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Carry-save adder: sum and carry of three words of bits."""
    t = a ^ x
    return t ^ y, (a & x) | (t & y)


def near_lanes(query: np.ndarray, rows: np.ndarray, plane: np.ndarray, live: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Lanes within ``radius`` (at most 7) of each query: ``(index of the row, word of lanes)``.

    ``rows`` names each query's block in ``plane``; ``live`` has the lanes to compare.
    """
    at = np.arange(len(query))
    ones, twos, fours = (np.zeros(len(query), np.uint64) for _ in range(3))
    over = ~live
    for b in range(0, 64, 8):
        x = [plane[rows, b + k] ^ (np.uint64(0) - ((query >> np.uint64(b + k)) & np.uint64(1))) for k in range(8)]
        ones, a = _add(ones, x[0], x[1])
        ones, c = _add(ones, x[2], x[3])
        twos, e = _add(twos, a, c)
        ones, a = _add(ones, x[4], x[5])
        ones, c = _add(ones, x[6], x[7])
        twos, f = _add(twos, a, c)
        fours, eights = _add(fours, e, f)
        over = over | eights | _above(ones, twos, fours, radius)
        keep = over != _ALL
        if not keep.all():
            at, query, rows, ones, twos, fours, over = (v[keep] for v in (at, query, rows, ones, twos, fours, over))
        if not len(at):
            break
    return at, ~over


def _above(ones: np.ndarray, twos: np.ndarray, fours: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose three-bit count is over ``radius``."""
    more, equal = np.zeros_like(ones), np.full_like(ones, _ALL)
    for value, counter in ((4, fours), (2, twos), (1, ones)):
        if radius & value:
            equal = equal & counter
        else:
            more |= equal & counter
            equal = equal & ~counter
    return more


def _settle(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Lower ``label`` until the ends of every link agree (labels are positions)."""
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            nxt = label[label]
            if (nxt == label).all():
                break
            label[:] = nxt
        differ = label[a] != label[b]
        a, b = a[differ], b[differ]


def _links(group: np.ndarray, side: np.ndarray, fp: np.ndarray, cross: np.ndarray, radius: int, budget: int = 1 << 19) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links ``(fingerprint, root)`` within each run of equal ``group``.

    ``cross``: whether the group compares side 0 with side 1 (else all with all).
    """
    n = len(fp)
    label = np.arange(n)
    key = group * 2 + np.where(cross, side, 0)
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.append(first, n))
    # runs of equal (group, side) in blocks of 64 lanes
    per = -(-size // 64)
    run = np.repeat(np.arange(len(first)), per)
    part = np.arange(len(run)) - np.repeat(np.cumsum(per) - per, per)
    start = first[run] + 64 * part
    lanes = np.minimum(64, first[run] + size[run] - start)
    pos = np.minimum(start[:, None] + np.arange(64), n - 1)
    plane = planes(np.ascontiguousarray(fp[pos]))
    live = np.where(lanes == 64, _ALL, (np.uint64(1) << (lanes % 64).astype(np.uint64)) - np.uint64(1))
    # pairs of blocks: within a run every block with itself and later ones; across, side 0 with side 1
    run_cross, run_side, run_group = cross[first], side[first], group[first]
    first_block = np.cumsum(per) - per
    left, right = [], []
    for r in np.flatnonzero((size > 1) & ~run_cross) if (per > 1).any() else []:
        if per[r] > 1:
            i, j = np.triu_indices(int(per[r]))
            left.append(first_block[r] + i)
            right.append(first_block[r] + j)
    single = np.flatnonzero((size > 1) & (per == 1) & ~run_cross)
    left.append(first_block[single])
    right.append(first_block[single])
    for r in np.flatnonzero(run_cross & (run_side == 0)):
        if r + 1 < len(first) and run_group[r + 1] == run_group[r]:
            i, j = np.meshgrid(np.arange(per[r]), np.arange(per[r + 1]), indexing="ij")
            left.append(first_block[r] + i.ravel())
            right.append(first_block[r + 1] + j.ravel())
    left, right = np.concatenate(left), np.concatenate(right)
    for k in range(0, len(left), budget // 64):
        i, j = left[k:k + budget // 64], right[k:k + budget // 64]
        q = np.repeat(start[i], lanes[i]) + _ranks(lanes[i])
        block = np.repeat(j, lanes[i])
        at, word = near_lanes(fp[q], block, plane, live[block], radius)
        hit = np.unpackbits(word.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, lane = np.nonzero(hit)
        _settle(label, q[at[row]], start[block[at[row]]] + lane)
    moved = np.flatnonzero(label != np.arange(n))
    return fp[moved], fp[label[moved]]


def _ranks(counts: np.ndarray) -> np.ndarray:
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def links(x: list[np.ndarray]) -> pa.RecordBatch:
            a, b = _links(x[0], x[1], x[2].view(np.uint64), x[3].astype(bool), radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            key = [c.to_numpy(zero_copy_only=False) for c in batch.columns]  # table, key, pair, side, fp, cross
            new = [C.chain([key[0].astype(np.uint64), key[1].view(np.uint64), key[2].view(np.uint64)]).view(np.int64) >> 1, key[3], key[4], key[5]]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
            ends = np.flatnonzero(held[0][1:] != held[0][:-1])
            if len(ends) and len(held[0]) >= 4096:
                cut = int(ends[-1]) + 1
                yield links([x[:cut] for x in held])
                held = [x[cut:] for x in held]
        if held is not None and len(held[0]):
            yield links(held)
    return run


def bands(m: int) -> list[tuple[int, int]]:
    """``(shift, width)`` of ``m`` bands that cover 64 bits."""
    edges = [64 * k // m for k in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def band_count(n: int, radius: int) -> int:
    """The fewest bands whose buckets hold at most ``BUCKET`` of ``n`` spread-out fingerprints."""
    m = radius + 1
    while m < radius + 5 and n > BUCKET * 2 ** ((m - radius) * 64 // m):
        m += 1
    return m


def components(prints: DataFrame, fp_col: str, id_col: str, radius: int = 4) -> DataFrame:
    """Rows ``(fp, root, component_id)``, one per distinct fingerprint.

    ``root`` is the smallest fingerprint of the connected component, ``component_id`` the
    smallest non-null id (null if the component has none). Equal fingerprints are merged
    before anything is compared, so groups of copies cost one row. Buckets of over ``SHARD``
    fingerprints are split into shards and compared pair of shards by pair of shards.
    """
    if not 0 <= radius <= 7:
        raise ValueError("radius must be 0 to 7")
    fps = C.written(prints.groupBy(F.col(fp_col).alias("fp")).agg(F.min(id_col).alias("least")), "simhash-prints")
    m = band_count(fps.count(), radius)
    at = bands(m)

    def key(chosen: tuple[int, ...]) -> Column:
        out = F.lit(0).cast("long")
        for c in chosen:
            shift, width = at[c]
            out = F.shiftleft(out, width).bitwiseOR(F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1)))
        return out

    tables = [F.struct(F.lit(t).alias("t"), key(ch).alias("k")) for t, ch in enumerate(combinations(range(m), m - radius))]
    dealt = fps.select("fp", F.inline(F.array(*tables)).alias("t", "k"))
    big = dealt.groupBy("t", "k").agg(F.count("*").alias("n")).where(F.col("n") > SHARD)
    big = big.select("t", "k", F.ceil(F.col("n") / SHARD).cast("int").alias("shards"))
    dealt = dealt.join(big, ["t", "k"], "left").withColumn("shards", F.coalesce("shards", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("shards")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("shards") - 1), lambda o: F.struct(
        (F.least(o, F.col("own")).cast("long") * F.col("shards") + F.greatest(o, F.col("own"))).alias("pair"),
        (F.col("own") > o).cast("int").alias("side"), (F.col("own") != o).alias("crossed")))
    dealt = dealt.withColumn("own", own).select("t", "k", "fp", F.inline(others))
    dealt = dealt.select(F.col("t").cast("long").alias("t"), "k", "pair", F.col("side").cast("long").alias("side"), "fp",
                         F.col("crossed").cast("long").alias("crossed"))
    dealt = dealt.repartition("t", "k", "pair").sortWithinPartitions("t", "k", "pair", "side", "fp")
    links = dealt.mapInArrow(_compare(radius), "a long, b long")
    comp = C.min_components(links, "simhash")
    rooted = fps.join(comp, fps.fp == comp.node, "left").select("fp", F.coalesce("component", "fp").alias("root"), "least")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.select("fp", "root").join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4) -> DataFrame:
    """``doc_id, fingerprint (16 hex digits), component_id`` for every row of ``docs``.

    Texts whose fingerprints differ in at most ``radius`` bits are linked; ``component_id`` is the
    smallest id reachable. Null, empty and blank texts have fingerprint zero and are linked like
    any other. Repeated rows give repeated rows; null ids keep their row, and a component of null
    ids only has a null ``component_id``; an empty table gives none.
    """
    base = C.id_text(docs, id_col, text_col)
    prints = C.written(base.select(F.col("_id").alias("doc_id"), fingerprint(F.col("_text"), shingle).alias("_fp")), "simhash")
    comp = components(prints, "_fp", "doc_id", radius)
    hexed = F.lpad(F.lower(F.hex("_fp")), 16, "0")
    return prints.join(comp, prints._fp == comp.fp).select("doc_id", hexed.alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the one with the smallest id.

    Columns as in ``docs``. Rows that repeat both id and group are reduced to the one whose text has
    the least XXH64.
    """
    fp, root, least, row = (C.free_name(docs, x) for x in ("_fp", "_root", "_least", "_row"))
    with_fp = C.written(docs.withColumn(fp, fingerprint(F.col(f"`{text_col}`"), shingle)), "simhash-docs")
    comp = components(with_fp, fp, f"`{id_col}`", radius).select(F.col("fp").alias(fp), F.col("root").alias(root), F.col("component_id").alias(least))
    kept = with_fp.join(comp, fp).where(F.col(f"`{id_col}`").eqNullSafe(F.col(least)))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = kept.groupBy(F.col(f"`{id_col}`"), root).agg(F.min_by(whole, F.xxhash64(f"`{text_col}`")).alias(row))
    return one.select(*[F.col(row)[c].alias(c) for c in docs.columns])
