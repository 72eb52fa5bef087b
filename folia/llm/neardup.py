"""MinHash near-dedup by thrown darts (DartMinHash), banded joining and exact checks.

The elements of a text are its distinct shingles of five words (one shingle of all
words, if there are fewer), weighted by how often they occur. Every unit of an
element's weight is a region of width one, over which darts fall along a rank
axis as a Poisson process that depends on the element and the unit alone. Layers
of the rank axis double in width and are thrown until every coordinate has a dart;
the earliest dart of each of `bands * rows` coordinates is the signature. The cost
is about k log k darts a text, whatever its length, beside one hash per shingle.

Signatures are cut into bands. Texts that agree in a band meet in a bucket; with 32
bands of 6 rows, two texts of similarity 0.8 meet with probability 0.9999. Exact copies are one
text, told by a digest of the whole text. Pairs are checked by exact weighted Jaccard
similarity of the shingles, in two steps.

First every member of a bucket is checked against one head of it, chosen by one of a few
orders, which differ from band to band: a few checks a text, whatever the sizes of the buckets.
The links found make components. Then texts of buckets with several components meet by an exact
prefix filter: sort the elements of a text (shingle and copy number) by rising frequency among
these texts. Two texts of a and b elements that are `least` alike share at least
least / (1 + least) * (a + b) of them, so the rarest element they share stands so early in both
that enough others can follow. Only texts that share such an element and are in different
components are compared. Texts that differ in a fifth of their shingles from all others have no such
element, however many share the rest; pairs within a group of texts that are alike but not
alike enough never arise from the passage that they share. What can still grow with the square
of a group are texts that are made of frequent shingles only, put together in many ways.

Defined results: a text without words has no shingles and is alike only to equal
texts (null counts as empty). Rows that share id and text are one document; texts that
share an id but differ are documents of their own, each with its own class. A null
id has no class and stays out of all others' classes.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folia.llm.bytesops import U64, Texts, chunks, mix, pack, ranges, texts, window_hashes
from folia.llm.common import id_text, located, map_arrow, written
from folia.llm.components import components, joined

LONG = pa.int64()
EMPTY = U64(0xFFFFFFFFFFFFFFFF)
SIGNED = [("digest", pa.binary()), ("words", LONG), ("bands", pa.list_(LONG))]
PACKED = pa.schema([("doc_id", LONG), ("digest", pa.binary()), ("packed", pa.binary())])
ELEMENTS = pa.schema([("u", LONG), ("root", LONG), ("size", LONG), ("element", LONG)])
CHECKED = pa.schema([("u", LONG), ("v", LONG), ("similarity", pa.float64())])
GROUP = 256  # texts whose darts are in memory at a time
BLOCK = 256  # texts of an element that meet as many others in a task
ORDERS = 8  # orders by which heads of buckets are chosen


def shingles(t: Texts, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the shingles of each text, and offsets by text."""
    starts, ends, offsets = t.word_spans
    found, _, places = window_hashes(t.hashes(starts, ends), offsets, width)
    return found, places


def units(found: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One fingerprint per unit of weight: the shingle and which of its copies it is."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((found, owner))
    ordered, who = found[order], owner[order]
    new = np.ones(len(ordered), bool)
    new[1:] = (ordered[1:] != ordered[:-1]) | (who[1:] != who[:-1])
    first = np.flatnonzero(new)
    copy = np.arange(len(ordered)) - np.repeat(first, np.diff(np.concatenate((first, [len(ordered)]))))
    return mix(ordered + copy.astype(U64) * U64(0xC2B2AE3D27D4EB4F))


def _poisson_steps(mean: float) -> np.ndarray:
    """Cumulative probabilities of a Poisson count, up to where they reach one."""
    k = np.arange(int(mean + 12 * np.sqrt(mean) + 24))
    logs = k * np.log(mean) - mean - np.concatenate(([0.0], np.cumsum(np.log(np.maximum(k[1:], 1)))))
    return np.cumsum(np.exp(logs))


def signatures(cells: np.ndarray, offsets: np.ndarray, k: int) -> np.ndarray:
    """The earliest dart of each coordinate, as the bits of its rank; EMPTY if none."""
    n = len(offsets) - 1
    weight = np.diff(offsets)
    best = np.full((n, k), EMPTY, U64)
    enough = k * (np.log(k) + 2) / np.maximum(weight, 1)
    active = weight > 0
    low, width, layer = 0.0, 1 / 16, 0
    while active.any():
        rows = np.flatnonzero(active)
        at = ranges(offsets[:-1][rows], weight[rows])
        owner = np.repeat(rows, weight[rows])
        seed = mix(cells[at] ^ mix(np.array([layer + 1], U64)))
        count = np.searchsorted(_poisson_steps(width), (seed >> U64(11)) * 2.0**-53)
        dart = np.repeat(np.arange(len(at)), count)
        number = ranges(np.zeros(len(count), np.int64), count).astype(U64)
        fall = mix(seed[dart] + (number + U64(1)) * U64(0x9E3779B97F4A7C15))
        rank = low + width * ((fall >> U64(11)) + U64(1)) * 2.0**-53
        coordinate = (mix(fall) % U64(k)).astype(np.int64)
        np.minimum.at(best.reshape(-1), owner[dart] * k + coordinate, rank.view(U64))
        low, layer = low + width, layer + 1
        width = low
        active &= (enough > low) | (best == EMPTY).any(1)
    return best


def coordinates(t: Texts, k: int, width: int = 5) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Signatures of GROUP texts at a time, and which of them have words."""
    found, offsets = shingles(t, width)
    cells = units(found, offsets)
    for a in range(0, t.size, GROUP):
        own = offsets[a : min(a + GROUP, t.size) + 1]
        yield signatures(cells[own[0] : own[-1]], own - own[0], k), np.diff(own) > 0


def sign(t: Texts, bands: int, rows: int, width: int = 5) -> list[list[int]]:
    """The band fingerprints of each text; none for a text without words."""
    out: list[list[int]] = []
    for signature, full in coordinates(t, bands * rows, width):
        best = signature.reshape(-1, bands, rows)
        key = np.zeros(best.shape[:2], U64)
        for r in range(rows):
            key = mix(key * U64(0x9E3779B97F4A7C15) + best[:, :, r])
        out += [x if has else [] for x, has in zip(key.view(np.int64).tolist(), full.tolist(), strict=True)]
    return out


def similarity(one: np.ndarray, other: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sorted multisets of shingles."""
    if not len(one) or not len(other):
        return float(len(one) == len(other))
    a, n = np.unique(one, return_counts=True)
    b, m = np.unique(other, return_counts=True)
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    shared = np.minimum(n[i], m[j]).sum()
    return shared / (len(one) + len(other) - shared)


def _check(pairs: DataFrame, packed: DataFrame, least: float) -> DataFrame:
    """The pairs (u, v) of at least that similarity, by their whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        held: OrderedDict[int, np.ndarray] = OrderedDict()

        def of(key: int, raw: pa.Scalar) -> np.ndarray:
            if key not in held:
                held[key] = np.sort(shingles(texts([unpack(raw.as_py()).decode()]))[0])
                if len(held) > 64:
                    held.popitem(last=False)
            return held[key]

        for batch in batches:
            u, v = batch.column("u").to_pylist(), batch.column("v").to_pylist()
            score = [similarity(of(x, batch.column("packed_u")[i]), of(y, batch.column("packed_v")[i])) for i, (x, y) in enumerate(zip(u, v, strict=True))]
            yield pack({"u": u, "v": v, "similarity": score}, CHECKED)

    first = packed.select("u", F.col("packed").alias("packed_u"))
    second = packed.select(F.col("u").alias("v"), F.col("packed").alias("packed_v"))
    both = pairs.join(first, "u").join(second, "v")
    return map_arrow(both, run, CHECKED).filter(F.col("similarity") >= least).select("u", "v")


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per element of each text."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for k, raw in enumerate(batch.column("packed")):
            own = np.sort(units(*shingles(texts([unpack(raw.as_py()).decode()])))).view(np.int64)
            same = lambda name: np.full(len(own), batch.column(name)[k].as_py(), np.int64)  # noqa: B023, E731
            yield pack({"u": same("u"), "root": same("root"), "size": np.full(len(own), len(own)), "element": own}, ELEMENTS)


def _prefixes(opened: DataFrame, packed: DataFrame, least: float) -> DataFrame:
    """The elements (element, u, root, size, place) of each text by which it can meet another
    that is `least` alike: those before `least` of the text, the rarest first.

    Elements that only one text has lead nowhere, but hold their places.
    """
    elements = written(map_arrow(packed.join(opened, "u").select("u", "root", "packed"), _elements, ELEMENTS), "elements")
    often = written(elements.groupBy("element").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "frequencies")
    counted = elements.join(often, "element", "left").withColumn("n", F.coalesce("n", F.lit(1)))
    place = F.row_number().over(Window.partitionBy("u").orderBy("n", "element")) - 1
    placed = counted.withColumn("place", place)
    return placed.filter((F.col("n") > 1) & (F.col("place") <= F.col("size") * (1 - least) + 1e-6)).drop("n")


def _several(prefixes: DataFrame) -> DataFrame:
    """Elements of several components: how many texts they have (n), how many of them are outside
    the element's largest component (n_rest), and that component (main)."""
    by_root = prefixes.groupBy("element", "root").agg(F.count(F.lit(1)).alias("k"))
    whole = by_root.groupBy("element").agg(F.sum("k").alias("n"), F.max(F.struct("k", "root")).alias("top"))
    return whole.select("element", "n", (F.col("n") - F.col("top.k")).alias("n_rest"), F.col("top.root").alias("main")).filter("n_rest > 0")


def _open_pairs(prefixes: DataFrame, several: DataFrame, least: float, block: int = BLOCK) -> DataFrame:
    """All pairs (u, v) of different components that share an element with enough behind it.

    One of each pair is outside the element's largest component. Those texts in blocks
    meet all texts in blocks, so a task holds two blocks of an element, however many have it.
    """
    sized = prefixes.join(several, "element")
    rest_blocks, blocks = (F.ceil(F.col(n) / block).cast("int") for n in ("n_rest", "n"))
    own = lambda n: F.pmod(F.xxhash64("u", F.lit(block)), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = (F.col("size") - F.col("place")).alias("left")
    rest = sized.filter("root <> main").select("element", own(rest_blocks).alias("i"), every(blocks).alias("j"), "u", "root", "size", left)
    renamed = [F.col("u").alias("v"), F.col("root").alias("other"), F.col("size").alias("v_size"), left.alias("v_left")]
    whole = sized.select("element", every(rest_blocks).alias("i"), own(blocks).alias("j"), *renamed)
    # So many elements two texts share at least; the shared one and those behind it must be enough.
    shared = (F.col("size") + F.col("v_size")) * (least / (1 + least)) - 1e-6
    fit = (F.col("root") != F.col("other")) & (F.col("left") >= shared) & (F.col("v_left") >= shared)
    pairs = rest.join(whole, ["element", "i", "j"]).filter(fit)
    return pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _digest(text: str) -> F.Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)).alias("digest")


def _grouped(rows: DataFrame, least: float, bands: int, per_band: int) -> tuple[DataFrame, DataFrame]:
    """The rows without their text but with its digest, and the distinct texts: digest, u, first_id
    (the smallest id of that text) and group (the component, a number without meaning).

    `rows` has doc_id, text and further columns that are kept.
    """
    carried = [c for c in rows.columns if c != "text"]
    signed_schema = pa.schema([*[(c, LONG) for c in carried], *SIGNED])
    digested = rows.select(*carried, "text", _digest("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in chunks(batch.column("text")):
                own = batch.slice(t.first, t.last - t.first)
                kept = {c: own.column(c) for c in (*carried, "digest")}
                yield pack({**kept, "words": np.diff(t.word_spans[2]), "bands": sign(t, bands, per_band)}, signed_schema)

    signed = written(map_arrow(digested, run, signed_schema), "signatures")
    one = signed.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.first("bands").alias("bands"))
    # Written, so that a text keeps its number.
    distinct = written(one.withColumn("u", F.monotonically_increasing_id()), "texts")

    banded = distinct.select("u", F.posexplode("bands").alias("band", "bucket"))
    banded = banded.select("u", F.xxhash64("band", "bucket").alias("key"), F.xxhash64("u", F.col("band") % ORDERS).alias("turn"))
    heads = banded.groupBy("key").agg(F.min_by("u", "turn").alias("v"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = written(banded.select("u", "key").join(heads.select("key", "v"), "key"), "members")

    def packing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            yield pack({"doc_id": batch.column("doc_id"), "digest": batch.column("digest"), "packed": [squeeze((x or "").encode()) for x in batch.column("text").to_pylist()]}, PACKED)

    involved = members.select("u").distinct()
    wanted = distinct.join(involved, "u", "left_semi").select(F.col("first_id").alias("doc_id"), "digest", "u")
    some = map_arrow(digested.select("doc_id", "digest", "text"), packing, PACKED).join(wanted, ["doc_id", "digest"])
    packed = written(some.dropDuplicates(["doc_id", "digest"]).select("u", "packed"), "packed")

    pairs = members.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    roots = components(_check(pairs, packed, least))
    labelled = members.select("u", "key").join(roots, "u", "left").withColumn("root", F.coalesce("root", "u"))
    mixed = labelled.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b")
    opened = written(labelled.join(mixed.select("key"), "key", "left_semi").select("u", "root").distinct(), "open")
    if not opened.isEmpty():
        prefixes = written(_prefixes(opened, packed, least), "prefixes")
        pairs = written(_open_pairs(prefixes, _several(prefixes), least), "pairs")
        found = written(_check(pairs, packed, least), "links")
        if not found.isEmpty():
            roots = joined(roots, found)
    grouped = distinct.select("digest", "u", "first_id").join(roots, "u", "left")
    return signed.select(*carried, "digest"), written(grouped.withColumn("group", F.coalesce("root", "u")).drop("root"), "groups")


def near_duplicates(docs: DataFrame, least: float = 0.8, bands: int = 32, rows: int = 6) -> DataFrame:
    """One row per document: doc_id, text_id (the smallest id of that very text) and
    class_id (the smallest id of its class)."""
    signed, groups = _grouped(id_text(docs).filter("doc_id IS NOT NULL"), least, bands, rows)
    first = groups.groupBy("group").agg(F.min("first_id").alias("class_id"))
    classes = written(groups.join(first, "group").select("digest", F.col("first_id").alias("text_id"), "class_id"), "classes")
    known = signed.distinct().join(classes, "digest").select("doc_id", "text_id", "class_id")
    return known.unionByName(id_text(docs).filter("doc_id IS NULL").select("doc_id"), allowMissingColumns=True)


def one_of_each(docs: DataFrame, least: float = 0.8, bands: int = 32, rows: int = 6) -> DataFrame:
    """`docs` with one row of each class: that of the smallest id, and of rows that repeat it the
    first in the files. Rows without an id stay."""
    whole = located(docs, F.struct("*").alias("doc"))
    named = whole.select(F.col("doc.doc_id").cast("long").alias("doc_id"), F.col("doc.text").cast("string").alias("text"), "file", "row")
    signed, groups = _grouped(named.filter("doc_id IS NOT NULL"), least, bands, rows)
    placed = written(signed.join(groups.select("digest", "group"), "digest").select("group", "doc_id", "file", "row"), "placed")
    best = placed.groupBy("group").agg(F.min(F.struct("doc_id", "file", "row")).alias("best")).select("best.file", "best.row")
    dropped = written(placed.select("file", "row").join(best, ["file", "row"], "left_anti"), "dropped")
    return whole.join(dropped, ["file", "row"], "left_anti").select("doc.*")
