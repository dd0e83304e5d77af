"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check, groups.

A text's fingerprint has a bit set where more than half of its shingles' XXH64 hashes have it.
Fingerprints at most ``distance`` bits apart are linked.  The 64 bits are cut into ``BLOCKS``
blocks; a close pair differs in at most ``distance`` of them, so it agrees in some choice of
``BLOCKS - distance`` blocks.  Every distinct fingerprint is dealt out once per choice under the
bits of the chosen blocks, and fingerprints that meet are verified by their Hamming distance.

Equal fingerprints are one row from the start, so exact copies cost nothing.  Inside a meeting
group a search goes from fingerprint to fingerprint and emits one link per fingerprint reached:
a spanning forest of all links, never all pairs.  No link between groups is lost, because every
close pair meets at least once and the search of that meeting joins the two.  A pair meets in every
choice of blocks it agrees in; only the first of these emits its link.

Tasks take the rows of a meeting as they come.  One of more than ``MEETING`` fingerprints is handed
on and dealt out again by the bits that its own choice left open: these are cut into ``distance + 2``
blocks, of which a close pair agrees in two.  Fingerprints that still meet differ in 25 bits at most,
so no task ever holds more than 2**25 of them.

Defined results: a NULL text or one without words has fingerprint zero, linked like any other.
Rows without an id get a fingerprint and no component.  Rows that share an id are rows of their
own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroute.llm import words as W
from tallyroute.llm.components import components
from tallyroute.llm.store import map_arrow, stored

#: words in a shingle, seed of its hash, and bits in which linked fingerprints may differ
SHINGLE, SEED, DISTANCE = 4, 42, 4
#: blocks of the 64 bits; pairs agree in ``BLOCKS - DISTANCE`` of them, 27 bits or more
BLOCKS = 7
#: fingerprints that are searched together as they meet; larger meetings are dealt out again
MEETING = 4096
#: a key holds the number of its choice above a hash of the chosen bits
HASHED = 48


def _normal(piece: W.Piece) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words joined by single spaces, their spans there, and words per text."""
    data = W.LOWER[piece.data]
    starts, ends, texts = W.spans(piece, W.NOT_SPACE)
    counts = np.bincount(texts, minlength=len(piece))
    keep = W.NOT_SPACE[data]
    later = np.ones(len(starts), bool)
    later[1:] = texts[1:] == texts[:-1]
    if len(later):
        later[0] = False
    gaps = starts[later] - 1
    keep[gaps] = True
    data[gaps] = 32
    place = np.concatenate([[0], np.cumsum(keep)])
    return data[keep].tobytes(), place[starts], place[ends], counts


def shingle_hashes(piece: W.Piece, size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts of a piece, and the number of shingles per text."""
    raw, starts, ends, counts = _normal(piece)
    numbers = np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)
    base = np.cumsum(counts) - counts
    first = np.repeat(base, numbers) + _within(numbers)
    last = np.minimum(first + size, np.repeat(base + counts, numbers)) - 1
    view, digest = memoryview(raw), xxhash.xxh64_intdigest
    found = [digest(view[a:b], seed)
             for a, b in zip(starts[first].tolist(), ends[last].tolist())]
    return np.array(found, np.uint64), numbers


def _within(sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def majority(hashes: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Fingerprint of each text from the hashes of its shingles, which lie end to end."""
    out = np.zeros(len(numbers), np.uint64)
    stop = 0
    for k, n in enumerate(numbers.tolist()):
        start, stop = stop, stop + n
        if n == 0:
            continue
        ones = np.zeros(64, np.int64)
        for low in range(start, stop, 1 << 16):
            part = hashes[low:min(stop, low + (1 << 16))].astype("<u8").view(np.uint8)
            bits = np.unpackbits(part.reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int32)
        out[k] = np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0]
    return out


def _fingerprints(size: int, seed: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [majority(*shingle_hashes(piece, size, seed))
                      for piece in W.pieces(batch["text"])]
            found = np.concatenate(prints) if prints else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(W.signed(found))], names=["doc_id", "fingerprint"])
    return rows


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                 size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``doc_id`` and its 64-bit ``fingerprint`` (as a signed number), one row per input row."""
    named = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"),
                        F.col(f"`{text}`").cast("string").alias("text"))
    return map_arrow(named, _fingerprints(size, seed), "doc_id long, fingerprint long")


class Choices:
    """Choices of ``take`` out of ``blocks`` equal blocks of the bits in ``mask``, in order."""

    def __init__(self, blocks: int, take: int, mask: int = W.MASK) -> None:
        bits = [1 << k for k in range(64) if mask >> k & 1]
        edges = [len(bits) * k // blocks for k in range(blocks + 1)]
        self.blocks = [sum(bits[a:b]) for a, b in zip(edges, edges[1:])]
        self.chosen = list(combinations(range(blocks), take))
        self.masks = [sum(self.blocks[k] for k in chosen) for chosen in self.chosen]

    def first(self, differing: np.ndarray) -> np.ndarray:
        """Number of the first choice in which none of the ``differing`` bits lie."""
        found = np.full(len(differing), len(self.masks))
        for number in reversed(range(len(self.masks))):
            found[differing & np.uint64(self.masks[number]) == 0] = number
        return found


def block_keys(choices: Choices) -> list[Column]:
    """One key per choice of blocks: the number of the choice, then a hash of the chosen bits."""
    keys = []
    for number, mask in enumerate(choices.masks):
        bits = F.col("fingerprint").bitwiseAND(F.lit(mask - (mask >> 63 << 64)).cast("long"))
        low = F.xxhash64(F.lit(number), bits).bitwiseAND(F.lit((1 << HASHED) - 1))
        keys.append(low.bitwiseOR(F.lit(number << HASHED).cast("long")))
    return keys


def _forest(members: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of all close pairs of one group."""
    links, open_, queue = [], members, []
    while len(open_):
        if not queue:
            queue.append(open_[0])
            open_ = open_[1:]
            continue
        node = queue.pop()
        near = np.bitwise_count(open_ ^ node) <= distance
        links += [(int(node), int(other)) for other in open_[near]]
        queue += list(open_[near])
        open_ = open_[~near]
    return links


def _rows(a: np.ndarray, b: np.ndarray | None, key: np.ndarray | None) -> pa.RecordBatch:
    """Links ``a`` and ``b``, or fingerprints ``a`` that are handed on with their ``key``."""
    none = pa.nulls(len(a), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(W.signed(np.ascontiguousarray(a))),
         none if b is None else pa.array(W.signed(np.ascontiguousarray(b))),
         none if key is None else pa.array(key)], names=["a", "b", "key"])


def _links(distance: int, first: Callable[[np.ndarray, np.ndarray], np.ndarray],
           most: float = float("inf")):
    """Rows come sorted by key; groups of one are passed over, groups of two go in one step.

    ``first`` tells, by the numbers of choices and the differing bits, which links are emitted.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, value = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        passing = None  # the key of a meeting that is handed on
        for batch in chain(batches, [None]):
            if batch is not None:
                key = np.concatenate([key, batch["key"].to_numpy()])
                value = np.concatenate([value, batch["fingerprint"].to_numpy().view(np.uint64)])
            if passing is not None and len(key) and key[0] == passing:
                cut = int(np.searchsorted(key, passing, "right"))
                yield _rows(value[:cut], None, key[:cut])
                key, value = key[cut:], value[cut:]
            if not len(key):
                continue
            heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            bounds = np.append(heads, len(key))
            if batch is not None and len(key) - heads[-1] <= most:  # the last group may go on
                bounds = bounds[:-1]
            sizes = np.diff(bounds)
            twos = bounds[:-1][sizes == 2]
            one, other = value[twos], value[twos + 1]
            near = np.bitwise_count(one ^ other) <= distance
            found, choice = [np.stack([one[near], other[near]], 1)], [key[twos[near]]]
            large = (sizes > 2) & (sizes <= most)
            for start, size in zip(bounds[:-1][large].tolist(), sizes[large].tolist()):
                linked = _forest(value[start:start + size], distance)
                if linked:
                    found.append(np.array(linked, np.uint64))
                    choice.append(np.full(len(linked), key[start]))
            pairs, choice = np.concatenate(found), np.concatenate(choice)
            kept = first(choice >> HASHED, pairs[:, 0] ^ pairs[:, 1])
            yield _rows(pairs[kept, 0], pairs[kept, 1], None)
            for start, size in zip(bounds[:-1][sizes > most].tolist(), sizes[sizes > most].tolist()):
                passing = key[start]
                yield _rows(value[start:start + size], None, key[start:start + size])
            done = bounds[-1]
            key, value = key[done:], value[done:]
    return rows


class Again:
    """Choices within the bits that a choice of the first deal left open."""

    def __init__(self, choices: Choices, distance: int) -> None:
        self.outer = choices
        self.inner = [Choices(distance + 2, 2, W.MASK ^ mask) for mask in choices.masks]
        self.count = len(self.inner[0].masks)

    def deal(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every handed-on fingerprint once per inner choice."""
        for batch in batches:
            key = batch["key"].to_numpy()
            value = batch["a"].to_numpy().view(np.uint64)
            for number in np.unique(key >> HASHED).tolist():
                mine = key >> HASHED == number
                for k, mask in enumerate(self.inner[number].masks):
                    bits = W.mix(value[mine] & np.uint64(mask)) ^ key[mine].view(np.uint64)
                    low = W.mix(bits) & np.uint64((1 << HASHED) - 1)
                    dealt = low.astype(np.int64) | (number * self.count + k << HASHED)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(W.signed(value[mine])), pa.array(dealt)],
                        names=["fingerprint", "key"])

    def first(self, numbers: np.ndarray, differing: np.ndarray) -> np.ndarray:
        outer, inner = np.divmod(numbers, self.count)
        kept = self.outer.first(differing) == outer
        for number in np.unique(outer).tolist():
            mine = outer == number
            kept[mine] &= self.inner[number].first(differing[mine]) == inner[mine]
        return kept


def near_links(distinct: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS,
               most: int = MEETING) -> DataFrame:
    """Pairs of distinct fingerprints that hold all groups of close ones together."""
    choices = Choices(blocks, blocks - distance)
    again = Again(choices, distance)
    if len(choices.masks) * again.count >= 1 << 63 - HASHED:
        raise ValueError("too many choices of blocks")
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def meet(dealt: DataFrame, function: Callable) -> DataFrame:
        met = dealt.repartition(parts, "key").sortWithinPartitions("key", "fingerprint")
        return map_arrow(met, function, "a long, b long, key long")

    dealt = distinct.select("fingerprint", F.explode(F.array(*block_keys(choices))).alias("key"))
    found = stored(meet(dealt, _links(
        distance, lambda numbers, bits: choices.first(bits) == numbers, most)), "met")
    large = map_arrow(found.where("key IS NOT NULL").select("a", "key"), again.deal,
                      "fingerprint long, key long")
    return found.where("key IS NULL").select("a", "b").union(
        meet(large, _links(distance, again.first)).select("a", "b"))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                    size: int = SHINGLE, seed: int = SEED, distance: int = DISTANCE,
                    blocks: int = BLOCKS) -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``component_id``, one row per input row."""
    if blocks <= distance:
        raise ValueError("more blocks than differing bits are needed")
    prints = stored(fingerprints(docs, id_column, text, size, seed), "fingerprints")
    holders = stored(
        prints.where("doc_id IS NOT NULL").groupBy("fingerprint")
        .agg(F.min("doc_id").alias("holder")), "holders")
    links = near_links(holders, distance, blocks)
    by_doc = (
        links.join(holders.select(F.col("fingerprint").alias("a"), F.col("holder").alias("x")), "a")
        .join(holders.select(F.col("fingerprint").alias("b"), F.col("holder").alias("y")), "b"))
    grouped = components(by_doc, "x", "y")
    component = (
        holders.join(grouped, holders["holder"] == grouped["node"], "left")
        .select("fingerprint", F.coalesce("component", "holder").alias("component_id")))
    return (
        prints.join(component, "fingerprint", "left")
        .select("doc_id", "fingerprint",
                F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")))


def digest(df: DataFrame) -> DataFrame:
    return df.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
                     "component_id")


def brute_force(rows, size: int = SHINGLE, seed: int = SEED, distance: int = DISTANCE):
    """The same by comparing every pair; for tests."""
    import re

    prints = []
    for i, text in rows:
        words = re.findall("[^\\x20\\x09-\\x0D]+",
                           re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        grams = [" ".join(words[k:k + size]) for k in range(max(1, len(words) - size + 1))]
        hashes = [xxhash.xxh64_intdigest(g.encode(), seed) for g in grams] if words else []
        value = sum(1 << b for b in range(64)
                    if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))
        prints.append((i, value))
    by_id = {i: i for i, _ in prints if i is not None}

    def root(i):
        while by_id[i] != i:
            i = by_id[i]
        return i

    known = [(i, p) for i, p in prints if i is not None]
    for k, (i, p) in enumerate(known):
        for j, q in known[:k]:
            if (p ^ q).bit_count() <= distance:
                x, y = sorted((root(i), root(j)))
                by_id[y] = x
    return [(i, f"{p:016x}", None if i is None else root(i)) for i, p in prints]
