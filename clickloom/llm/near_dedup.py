"""Near-duplicate documents: MinHash bands, sequential Bayesian verification, exact confirmation.

Candidates are documents that agree in a band of their MinHash signatures. Their signatures are
compared batch by batch, and a pair is dropped as soon as the posterior chance that its similarity
reaches the threshold is below the miss probability. What survives is confirmed on the full sets.

Pairs are never made within a bucket. Each member is held against the bucket's smallest one and the
one that meets most others; what that links falls into components. Buckets that still hold several
components are cut into tiles of a few hundred members; a component with many members in a bucket has tiles
of its own, which all its buckets share. Two tiles that meet in a bucket are compared inside a task, signatures
first and then, in buckets of more than ``FEW`` members, the short hashes of their full sets, which bound the similarity
from above: only promising pairs of different components leave it, each
from the first bucket its members share, and are confirmed. In a first round each member of a tile pair leaves with its best
partner alone, which mostly connects a group; a second one has every pair that is still in two
components. So every candidate is either compared or already connected.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.components import components
from clickloom.llm.storage import lasting, small, stored, tidied
from clickloom.llm.texts import LOWER, give_back, mix, slices, span_hashes, utf8, window_hashes, word_spans
from clickloom.session import ship_package

BANDS, ROWS = 80, 8
BATCH = 64
# Members of a bucket that are compared with one another at a time, and shingles of them, about.
TILE, TILE_SHINGLES = 256, 500_000
# A bucket of so many members can't make many pairs.
FEW = 32
_PAIRS_AT_ONCE = 1 << 17
_PASSED_AT_ONCE = 1 << 12
_CELLS = 1 << 17
_DOCS_AT_ONCE = 500


def shingle_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's runs of ``words`` words, A-Z lowered; fewer words are one run."""
    data, bounds = utf8(column)
    for low, high in slices(bounds):
        part = bounds[low : high + 1] - bounds[low]
        piece = LOWER[data[bounds[low] : bounds[high]]]
        starts, ends, first = word_spans(piece, part)
        hashes = span_hashes(piece, starts, ends)
        for row in range(high - low):
            own = hashes[first[row] : first[row + 1]]
            yield np.unique(window_hashes(own, min(words, len(own)))) if len(own) else own


@lru_cache(maxsize=2)
def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    halves = (seeds >> np.uint64(32)).astype(np.uint32)
    return halves[:n, None], halves[n:, None] | np.uint32(1)


def signature(shingles: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` minima over hash functions of a set that isn't empty."""
    flip, factor = _functions(n)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(n, 0xFFFFFFFF, np.uint32)
    step = max(1, _CELLS // n)
    for low in range(0, len(short), step):
        values = (short[None, low : low + step] ^ flip) * factor
        np.minimum(least, values.min(axis=1), out=least)
    return least


def codes_of(least: np.ndarray) -> np.ndarray:
    """One byte of each minimum.

    Minima are small numbers, the more so the longer the text is: their bits are mixed first, so that
    different minima agree by chance as rarely as ``least_matches`` assumes.
    """
    return (mix(least.astype(np.uint64)) & np.uint64(255)).astype(np.uint8)


def band_keys(codes: np.ndarray, bands: int) -> np.ndarray:
    """A key for each band of the rows of ``codes``: equal where all codes of the band are."""
    banded = codes.reshape(len(codes), bands, codes.shape[1] // bands).astype(np.uint64)
    keys = np.broadcast_to(np.arange(bands, dtype=np.uint64), banded.shape[:2])
    for c in range(banded.shape[2]):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + banded[:, :, c])
    return keys


def similar_sets(a: np.ndarray, b: np.ndarray, threshold: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return bool(common) and 100 * common >= threshold * (len(a) + len(b) - common)


def may_be_similar(a: np.ndarray, b: np.ndarray, threshold: int) -> bool:
    """Whether sets with these sorted short hashes can reach the threshold: equal hashes may be one shingle."""
    own, other = np.unique(a), np.unique(b)
    common = len(np.intersect1d(own, other, assume_unique=True)) + min(len(a) - len(own), len(b))
    return 100 * common >= threshold * (len(a) + len(b) - common)


def least_matches(threshold: float, miss: float, n: int, batch: int = BATCH, values: int = 256) -> list[tuple[int, int]]:
    """After how many compared components how many have to agree, for the pair to go on.

    Components of ``values`` values agree by chance as well. With a uniform prior, the posterior of
    the rate of agreement is a beta distribution, and the chance that it reaches the rate at the
    threshold is a binomial tail.
    """
    rules = []
    threshold += (1 - threshold) / values
    for seen in [*range(batch, n, batch), n]:
        tail, agree = 0.0, 0
        while agree <= seen:
            tail += comb(seen + 1, agree) * threshold**agree * (1 - threshold) ** (seen + 1 - agree)
            if tail >= miss:
                break
            agree += 1
        rules.append((seen, agree))
    return rules


def passing(one: np.ndarray, other: np.ndarray, i: np.ndarray, j: np.ndarray, rules: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Which of the pairs of rows ``one[i]``, ``other[j]`` pass all rules, and how many components of each agree."""
    going, agree, seen = np.arange(len(i)), np.zeros(len(i), np.int64), 0
    for upto, least in rules:
        same = one[:, seen:upto][i[going]] == other[:, seen:upto][j[going]]
        agree = agree + np.count_nonzero(same, axis=1)
        still = agree >= least
        going, agree, seen = going[still], agree[still], upto
    return going, agree


def meet_before(one: np.ndarray, other: np.ndarray, i: np.ndarray, j: np.ndarray, of_band: np.ndarray, bands: int) -> np.ndarray:
    """Which of the pairs of rows ``one[i]``, ``other[j]`` agree in all codes of a band before ``of_band``."""
    met = np.empty(len(i), bool)
    for low in range(0, len(i), _PASSED_AT_ONCE):
        part = slice(low, low + _PASSED_AT_ONCE)
        same = (one[i[part]] == other[j[part]]).reshape(len(i[part]), bands, -1).all(axis=2)
        met[part] = (same & (np.arange(bands) < of_band[part][:, None])).any(axis=1)
    return met


def best_partners(a: np.ndarray, b: np.ndarray, agree: np.ndarray) -> np.ndarray:
    """Positions of pairs that are the best one of either member; ties go to the smaller partner."""
    chosen = []
    for own, partner in ((a, b), (b, a)):
        order = np.lexsort((partner, -agree, own))
        chosen.append(order[np.concatenate([[True], own[order][1:] != own[order][:-1]])] if len(order) else order)
    return np.unique(np.concatenate(chosen))


class _Tile:
    """The members of all tiles of one side of a batch; ``bounds`` says where each tile's begin."""

    def __init__(self, column: pa.ListArray, n: int):
        flat = column.flatten()
        self.bounds = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        self.rep, self.label, self.size = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("rep", "label", "n"))
        self.code = np.frombuffer(b"".join(flat.field("code").to_pylist()), np.uint8).reshape(-1, n)
        self._sets = flat.field("shingles")

    def set_of(self, member: int) -> np.ndarray | None:
        held = self._sets[int(member)]
        return np.frombuffer(held.as_buffer(), np.uint32) if held.is_valid else None


def compare_tiles(
    batch: pa.RecordBatch, bands: int, n: int, rules: list[tuple[int, int]], threshold: int, best_only: bool
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Promising pairs ``a`` < ``b`` of different components, of members that share no bucket of an earlier band.

    The first column is the band of each row's bucket (0 between tiles of no single bucket), the second has tiles,
    the third those each is compared with, if there is one: else a tile's members are compared with one another.
    """
    band = batch.column(0).to_numpy()
    one = _Tile(batch.column(1), n)
    other = _Tile(batch.column(2), n) if batch.num_columns > 2 else one
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def compared() -> tuple[np.ndarray, np.ndarray]:
        i, j, of_band = (np.concatenate(side) for side in zip(*held))
        held.clear()
        kept, agree = passing(one.code, other.code, i, j, rules)
        i, j = i[kept], j[kept]
        new = ~meet_before(one.code, other.code, i, j, of_band[kept], bands)
        i, j, agree = i[new], j[new], agree[new]
        sets = ((one.set_of(x), other.set_of(y)) for x, y in zip(i, j))
        linked = np.fromiter((x is None or y is None or may_be_similar(x, y, threshold) for x, y in sets), bool, len(i))
        a, b, agree = one.rep[i[linked]], other.rep[j[linked]], agree[linked]
        chosen = best_partners(a, b, agree) if best_only else slice(None)
        return np.minimum(a, b)[chosen], np.maximum(a, b)[chosen]

    waiting = 0
    for row in range(len(batch)):
        i, j = (np.arange(side.bounds[row], side.bounds[row + 1]) for side in (one, other))
        apart = one.label[i][:, None] != other.label[j][None, :]
        x, y = one.size[i][:, None], other.size[j][None, :]
        apart &= 100 * np.minimum(x, y) >= threshold * np.maximum(x, y)
        if other is one:
            apart = np.triu(apart, 1)
        at_i, at_j = np.nonzero(apart)
        if len(at_i):
            held.append((i[at_i], j[at_j], np.full(len(at_i), band[row])))
            waiting += len(at_i)
        if waiting >= _PAIRS_AT_ONCE:
            yield compared()
            waiting = 0
    if held:
        yield compared()


@tidied
def component_ids(
    docs: DataFrame, words: int = 5, threshold: int = 80, bands: int = BANDS, rows: int = ROWS, miss: float = 1e-6
) -> DataFrame:
    """Columns ``doc_id``, ``n_shingles``, ``component_id``, ``kept``; a row for each row of ``docs``.

    Documents are linked when 100 times the number of common shingles (distinct runs of ``words`` words,
    A-Z lowered; fewer words are one run) is at least ``threshold`` times the number of all of theirs.
    ``component_id`` is the smallest ``doc_id`` that links reach, ``kept`` whether it is the row's own.
    A null, empty or blank text has no shingles and is linked with nothing. A row without ``doc_id``
    takes no part: it has no component and is kept. Rows of one ``doc_id`` are one document; a repeated
    row gets the same result each time. Other columns are not read.

    Exact copies are linked by their sets' hash before all else. A linked pair is no candidate with
    probability ``(1 - s ** rows) ** bands`` at similarity s (4e-7 at 0.8), and is dropped early with ``miss``.
    Texts of any length are taken whole. The work on a bucket of texts just below the threshold to one another grows
    with its square, in blocks of tiles over many tasks; the rows that leave them do not.
    """
    spark = docs.sparkSession
    ship_package(spark)
    n = bands * rows

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(low, _DOCS_AT_ONCE) for whole in batches for low in range(0, len(whole), _DOCS_AT_ONCE)):
            sizes, one, two, keys, codes = [], [], [], [], []
            for shingles in shingle_sets(batch.column(1), words):
                sizes.append(len(shingles))
                one.append(int(np.bitwise_xor.reduce(shingles)) if len(shingles) else 0)
                two.append(int(np.add.reduce(mix(shingles + np.uint64(7)))) if len(shingles) else 0)
                if len(shingles):
                    least = signature(shingles, n)
                    short = codes_of(least)
                    keys.append(band_keys(short[None, :], bands)[0].view(np.int64))
                    codes.append(short.tobytes())
                else:
                    keys.append(np.empty(0, np.int64))
                    codes.append(b"")
            ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            flat = np.concatenate(keys) if keys else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(np.array(one, np.uint64).view(np.int64)), pa.array(np.array(two, np.uint64).view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(codes, pa.binary())],
                ["doc_id", "n_shingles", "set1", "set2", "keys", "code"],
            )
            give_back()

    own = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    sketches = stored(own.mapInArrow(sketch, "doc_id long, n_shingles long, set1 long, set2 long, keys array<long>, code binary"), "sketches")
    identity = ["set1", "set2", "n_shingles"]
    placed = sketches.filter("doc_id is not null and n_shingles > 0")
    # Of the documents with one and the same set, the smallest id stands for all.
    sets = stored(placed.groupBy(*identity).agg(F.min("doc_id").alias("rep")), "sets")
    reps = placed.join(sets, identity).filter("doc_id = rep")
    member = reps.select(F.posexplode("keys").alias("band", "bucket"), "rep")
    centers = member.groupBy("bucket").agg(F.min("rep").alias("center"), F.max("rep").alias("last"), F.count("*").alias("held")).filter("center <> last")
    shared = stored(member.join(centers.drop("last"), "bucket"), "buckets")
    # The text that others were copied from meets more of them than they meet each other, so the member
    # that meets most links most.
    meetings = stored(shared.groupBy("rep").agg(F.sum("held").alias("meets")), "meetings")
    hubs = shared.join(meetings, "rep").groupBy("bucket").agg(F.max_by("rep", F.struct("meets", F.bitwise_not("rep"))).alias("hub"))
    codes = stored(reps.select("rep", "set1", F.col("n_shingles").alias("n"), "code"), "codes")

    rules = least_matches(threshold / 100, miss, n)
    texts = own.filter("doc_id is not null")

    def promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, n) for c in (2, 3))
            own = np.arange(len(batch))
            going, _ = passing(left, right, own, own, rules)
            yield batch.select([0, 1]).take(pa.array(going))
            give_back()

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(shingle_sets(batch.column(2), words), shingle_sets(batch.column(3), words))
            keep = [row for row, (a, b) in enumerate(pairs) if similar_sets(a, b, threshold)]
            yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))
            give_back()

    def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(low, _DOCS_AT_ONCE) for whole in batches for low in range(0, len(whole), _DOCS_AT_ONCE)):
            sets = list(shingle_sets(batch.column(1), words))
            set1 = np.array([np.bitwise_xor.reduce(own) for own in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(set1), pa.array([(own >> np.uint64(32)).astype(np.uint32).tobytes() for own in sets], pa.binary())], ["rep", "set1", "shingles"])
            give_back()

    def pruned(pairs: DataFrame) -> DataFrame:
        """Those of ``pairs`` (``a``, ``b``, representatives) that the rules let through."""
        coded = pairs.join(codes.select(F.col("rep").alias("a"), F.col("code").alias("code_a")), "a")
        coded = coded.join(codes.select(F.col("rep").alias("b"), F.col("code").alias("code_b")), "b")
        return coded.select("a", "b", "code_a", "code_b").mapInArrow(promising, "a long, b long")

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Those of ``pairs`` whose full sets are similar enough."""
        left = stored(pairs, "promising")
        ids = stored(left.select(F.col("a").alias("doc_id")).union(left.select("b")).distinct(), "ids")
        named = stored(texts.join(small(ids), "doc_id"), "texts")
        whole = left.join(named.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
        whole = whole.join(named.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
        return stored(whole.select("a", "b", "text_a", "text_b").mapInArrow(similar, "a long, b long"), "confirmed")

    def tiled(links: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Members of the buckets that hold several components, about ``TILE`` to a row, and the tiles of each bucket."""
        labels = components(links).withColumnRenamed("node", "rep")
        labelled = shared.join(labels, "rep", "left").select("bucket", "band", "held", "rep", F.coalesce("label", "rep").alias("label"))
        mixed = labelled.groupBy("bucket").agg(F.min("label").alias("first"), F.max("label").alias("last")).filter("first <> last").select("bucket")
        # A document's rows may differ in text: then it stands for several sets.
        members = stored(labelled.join(mixed, "bucket").join(codes.drop("code"), "rep"), "mixed")
        ids = stored(members.groupBy(F.col("rep").alias("doc_id")).agg(F.max("held").alias("held")), "ids")
        short = texts.join(small(ids.filter(F.col("held") > FEW).select("doc_id")), "doc_id").mapInArrow(full_sets, "rep long, set1 long, shingles binary")
        carried = codes.drop("n").join(small(ids.select(F.col("doc_id").alias("rep"))), "rep")
        carried = stored(carried.join(short.dropDuplicates(["rep", "set1"]), ["rep", "set1"], "left").dropDuplicates(["rep", "set1"]), "carried")
        # A component with many members in a bucket has tiles of its own, which needn't be compared with each
        # other; a member is in one of them alone, whatever the number of its buckets, beside those it meets in the
        # fullest. Other members are parted by size, so that tiles too far apart in size aren't compared either.
        large = stored(members.groupBy("bucket", "label").agg(F.count("*").alias("together")).filter(F.col("together") >= TILE // 4), "large")
        fullest = F.max(F.struct("together", "bucket")).over(Window.partitionBy("rep", "set1"))["bucket"]
        size = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.25)))
        own = F.col("together").isNotNull()
        place = {"place": F.when(own, fullest).otherwise(F.col("bucket")), "whose": F.when(own, F.col("label")).otherwise(0),
                 "size": F.when(own, -1).otherwise(size), "band": F.when(own, 0).otherwise(F.col("band"))}
        placed = stored(members.join(small(large), ["bucket", "label"], "left").withColumns(place), "placed")
        parts = ["place", "whose", "size"]
        once = [*parts, "rep", "set1"]
        tiles_of = F.ceil(F.greatest(F.count("*") / TILE, F.sum("n") / TILE_SHINGLES))
        crowded = stored(placed.dropDuplicates(once).groupBy(*parts).agg(tiles_of.alias("tiles")).filter("tiles > 1"), "crowded")
        number = F.pmod(F.xxhash64("rep"), F.coalesce("tiles", F.lit(1)))
        placed = placed.join(small(crowded), parts, "left").withColumn("number", number)
        whole = placed.dropDuplicates(once).join(carried, ["rep", "set1"]).withColumn("shingles", F.when(F.col("held") > FEW, F.col("shingles")))
        tiles = whole.groupBy(*parts, "number").agg(
            F.min("band").alias("band"), F.collect_list(F.struct("rep", "label", "n", "code", "shingles")).alias("members"),
            F.min("n").alias("low"), F.max("n").alias("high"), F.min("label").alias("first"), F.max("label").alias("last"),
        )
        tiles = stored(tiles.withColumn("tile", F.monotonically_increasing_id()), "tiles")
        at = placed.select("bucket", *parts, "number").distinct()
        return tiles, stored(at.join(tiles.drop("members", "band"), [*parts, "number"]).drop(*parts, "number"), "places")

    def across(tiles: DataFrame, places: DataFrame, best_only: bool) -> DataFrame:
        """Promising pairs of different components, within tiles and between tiles that meet in a bucket."""

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a, b in compare_tiles(batch, bands, n, rules, threshold, best_only):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
                give_back()

        within = tiles.filter("first <> last").select("band", "members").mapInArrow(compare, "a long, b long")
        one, other = (places.select("bucket", *[F.col(c).alias(f"{c}_{side}") for c in ("tile", "low", "high", "first", "last")]) for side in "ab")
        in_reach = f"100 * high_a >= {threshold} * low_b and 100 * high_b >= {threshold} * low_a"
        one_component = "first_a = last_a and first_b = last_b and first_a = first_b"
        meet = one.join(other, "bucket").filter(f"tile_a < tile_b and {in_reach} and not ({one_component})").select("tile_a", "tile_b").distinct()
        for side in "ab":
            meet = meet.join(tiles.select(*[F.col(c).alias(f"{c}_{side}") for c in ("tile", "band", "members")]), f"tile_{side}")
        between = meet.select(F.greatest("band_a", "band_b").alias("band"), "members_a", "members_b").mapInArrow(compare, "a long, b long")
        return within.unionByName(between).distinct()

    # Copies of a set under several ids of which one stands for two sets connect those.
    copies = placed.join(sets, identity).filter("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    to_first = shared.select(F.col("center").alias("other"), "rep")
    to_hub = shared.join(hubs, "bucket").select(F.col("hub").alias("other"), "rep")
    rays = to_first.unionByName(to_hub).filter("rep <> other").select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b"))
    links = confirmed(pruned(rays.distinct()))
    for best_only in (True, False):
        links = links.unionByName(confirmed(across(*tiled(links), best_only)))
    final = lasting(components(links.unionByName(copies)), "components")
    sizes = lasting(sketches.select("doc_id", "n_shingles"), "sizes")
    found = sizes.join(final.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    component = F.coalesce("label", "doc_id")
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, with all columns, of documents that are the first of their component."""
    gone = component_ids(docs, **options).filter("not kept").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, F.col("doc_id").cast("long") == F.col("__gone"), "left_anti")
