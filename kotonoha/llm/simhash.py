"""SimHash near-duplicates through vantage-point trees.

Every text gets one 64-bit fingerprint; equal fingerprints are merged before
anything is searched, so a group of copies of any size is one row. Distinct
fingerprints are dealt to shards by a vantage-point tree: a node holds a vantage
fingerprint v and a radius r, and x goes inside if distance(x, v) <= r, else
outside. Two fingerprints at distance d or less on different sides put the
inside one within d of the boundary (triangle inequality), so only inside points
with distance > r - d are also sent outside: every pair meets in at least one
shard. In a shard the same rule prunes a local tree down to blocks that are
compared exactly. A shard returns one (fingerprint, root) row per linked
fingerprint, never its pairs, and the connected components of these rows are
found by alternating large-star and small-star joins.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kotonoha.llm.common import LOWER_BYTES, column, free_names, slices, utf8
from kotonoha.plans.layout import cut_lineage

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
# The shard tree is fitted on about this many distinct fingerprints, drawn by
# hash, and has this many shards at most.
TREE_SAMPLE = 50_000
MAX_SHARDS = 4096
# (id, hash) rows that are sent to all tasks; with more, texts are joined by a shuffle.
BROADCAST_KEYS = 500_000
# Fingerprints that are compared with each other directly.
BLOCK = 1024
# Cells of a comparison that are in memory at one time.
CELLS = 1 << 21


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Majority bits of the XXH64 hashes of all word shingles; 0 without words."""
    found = utf8(text).translate(LOWER_BYTES).split()
    if not found:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(found) <= words:
        return digest(b" ".join(found), SEED)
    counts = np.zeros(64, np.int64)
    total = len(found) - words + 1
    for start in range(0, total, 1 << 16):
        stop = min(total, start + (1 << 16))
        if words == 3:
            parts = zip(found[start:stop], found[start + 1 : stop + 1], found[start + 2 : stop + 2], strict=True)
            hashes = [digest(b"%b %b %b" % p, SEED) for p in parts]
        else:
            hashes = [digest(b" ".join(found[i : i + words]), SEED) for i in range(start, stop)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > total, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(
    docs: DataFrame, *, words: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(_doc, _fp): the fingerprint as a signed long, for every row."""
    id_type = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).cast("string").alias("_text"))

    def run(batches):
        for batch in slices(batches):
            found = np.array([fingerprint(t, words) for t in column(batch, "_text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["_doc", "_fp"])

    return source.mapInArrow(run, f"_doc {id_type}, _fp long")


def distance(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage)


def choose_split(points: np.ndarray, bits: int, rng: np.random.Generator) -> tuple[np.uint64, int] | None:
    """The vantage point and radius that leave the smallest larger side, or None.

    None: every split tried would leave nearly all points on one side.
    """
    best, chosen = 0.85 * len(points), None
    tried = points if len(points) <= 4096 else rng.choice(points, 4096, replace=False)
    scale = len(points) / len(tried)
    vantages = rng.choice(points, min(8, len(points)), replace=False)
    # A far-off vantage splits dense groups that no member splits well.
    for vantage in [*vantages, *~vantages[:2], *rng.integers(0, 1 << 64, 2, np.uint64, endpoint=False)]:
        counts = np.bincount(distance(tried, vantage), minlength=65)
        inside = np.cumsum(counts)
        lower = np.concatenate([np.zeros(bits, np.int64), inside])[:65]
        outside = len(tried) - lower  # those outside and the inside band
        larger = np.maximum(inside, outside) * scale
        radius = int(np.argmin(larger))
        if larger[radius] < best:
            best, chosen = larger[radius], (np.uint64(vantage), radius)
    return chosen


def fit_tree(sample: np.ndarray, shards: int, bits: int) -> list[tuple]:
    """Nodes (vantage, radius, inside, outside); a child below 0 is the shard -1 - child."""
    rng = np.random.default_rng(7)
    goal = max(1, len(sample) // shards)
    nodes: list = []
    shard = 0

    def grow(points: np.ndarray) -> int:
        nonlocal shard
        split = choose_split(points, bits, rng) if len(points) > max(goal, 8) else None
        if split is None:
            shard += 1
            return -shard
        vantage, radius = split
        at = len(nodes)
        nodes.append(None)
        far = distance(points, vantage)
        # The sample shows where points are; copies at boundaries are not counted.
        inside, outside = grow(points[far <= radius]), grow(points[far > radius])
        nodes[at] = (vantage, radius, inside, outside)
        return at

    grow(sample)
    return nodes


def route(nodes: list[tuple], points: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, shards): the shards in which each point must be compared."""
    if not nodes:
        return np.arange(len(points)), np.zeros(len(points), np.int64)
    positions, shards = [], []
    stack = [(0, np.arange(len(points)))]
    while stack:
        at, rows = stack.pop()
        if not len(rows):
            continue
        if at < 0:
            positions.append(rows)
            shards.append(np.full(len(rows), -1 - at))
            continue
        vantage, radius, inside, outside = nodes[at]
        far = distance(points[rows], vantage)
        stack.append((inside, rows[far <= radius]))
        stack.append((outside, rows[far > radius - bits]))
    if not positions:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(positions), np.concatenate(shards)


def _block_links(points: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(point, root) of the points of a block that have a neighbour, by exact comparison."""
    left = points
    members, roots = [], []
    while len(left) > 1:
        group = [left[:1]]
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            near = np.zeros(len(left), bool)
            step = max(1, CELLS // len(left))
            for start in range(0, len(front), step):
                cells = np.bitwise_count(front[start : start + step, None] ^ left[None, :])
                near |= (cells <= bits).any(axis=0)
            front, left = left[near], left[~near]
            group.append(front)
        if len(group) > 2 or len(group[-1]) and len(group) == 2:
            found = np.concatenate(group)
            members.append(found)
            roots.append(np.full(len(found), found.min()))
    if not members:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(members), np.concatenate(roots)


def shard_links(points: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(point, root) rows that connect all points of a shard within ``bits`` of each other."""
    rng = np.random.default_rng(11)
    members, roots = [], []
    stack = [np.unique(points)]
    while stack:
        some = stack.pop()
        split = choose_split(some, bits, rng) if len(some) > BLOCK else None
        if split is None:
            found, root = _block_links(some, bits)
            members.append(found)
            roots.append(root)
            continue
        far = distance(some, split[0])
        stack.append(some[far <= split[1]])
        stack.append(some[far > split[1] - bits])
    return np.concatenate(members), np.concatenate(roots)


def links(distinct: DataFrame, *, max_bits: int = MAX_BITS, fp_col: str = "_fp") -> DataFrame:
    """(_a, _b), _a > _b: rows whose connected components are those of all links.

    ``distinct`` holds distinct fingerprints as signed longs. Roots are chosen
    by unsigned order inside a shard and given as signed longs.
    """
    spark = distinct.sparkSession
    number = distinct.count()
    # Drawn by hash at a rate that follows from the count: tasks send no more than the draw.
    rate = min(1.0, TREE_SAMPLE / max(1, number))
    share = F.pmod(F.xxhash64(fp_col), F.lit(1 << 40)) / F.lit(float(1 << 40))
    sample = sorted(r[0] for r in distinct.where(share < rate).select(fp_col).collect())
    shards = max(1, min(MAX_SHARDS, number // BLOCK * 4, len(sample) // 8))
    nodes = fit_tree(np.array(sample, np.int64).view(np.uint64), shards, max_bits)
    tree = spark.sparkContext.broadcast(nodes)  # at most MAX_SHARDS nodes

    def deal(batches):
        for batch in batches:
            points = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            rows, shard = route(tree.value, points, max_bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard), pa.array(points[rows].view(np.int64))], names=["_shard", "_fp"]
            )

    def connect(group: pa.Table) -> pa.Table:
        points = group.column("_fp").to_numpy().astype(np.int64).view(np.uint64)
        found, root = shard_links(points, max_bits)
        found, root = found.view(np.int64), root.view(np.int64)
        apart = found != root
        found, root = found[apart], root[apart]
        return pa.table({"_a": np.maximum(found, root), "_b": np.minimum(found, root)})

    dealt = distinct.select(F.col(fp_col).alias("_fp")).mapInArrow(deal, "_shard long, _fp long")
    return dealt.groupBy("_shard").applyInArrow(connect, "_a long, _b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(_node, _root) of every node of (_a, _b) edges, _a > _b: smallest node of its component."""
    edges = cut_lineage(edges)

    def state(found: DataFrame):
        return found.agg(
            F.count("*"), F.sum(F.xxhash64("_a", "_b").cast("decimal(38,0)"))
        ).first()

    before = state(edges)
    while before[0]:
        # Large star: every larger neighbour of u is tied to the smallest one of u.
        both = edges.unionByName(edges.select(F.col("_b").alias("_a"), F.col("_a").alias("_b")))
        least = both.groupBy("_a").agg(F.min("_b").alias("_m"))
        least = least.select(F.col("_a").alias("_u"), F.least("_a", "_m").alias("_m"))
        large = (
            edges.join(least, edges["_b"] == least["_u"])
            .select("_a", F.col("_m").alias("_b"))
            .where("_a > _b")
            .distinct()
        )
        # Small star: u and all its smaller neighbours are tied to the smallest of them.
        lowest = large.groupBy(F.col("_a").alias("_u")).agg(F.min("_b").alias("_m"))
        tied = large.join(lowest, large["_a"] == lowest["_u"])
        small = (
            tied.select(F.explode(F.array(F.struct("_a", F.col("_m").alias("_b")), F.struct(F.col("_b").alias("_a"), F.col("_m").alias("_b")))).alias("_e"))
            .select("_e.*")
            .where("_a > _b")
            .distinct()
        )
        edges = cut_lineage(small)
        after = state(edges)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("_a").alias("_node"), F.col("_b").alias("_root"))
    return stars.unionByName(stars.select(F.col("_root").alias("_node"), "_root").distinct())


def _named_classes(prints: DataFrame, value, max_bits: int) -> DataFrame:
    """(_key, _component): for each distinct fingerprint the smallest ``value`` of its component."""
    distinct = cut_lineage(prints.groupBy("_fp").agg(F.min(value).alias("_least")))
    stars = cut_lineage(components(links(distinct, max_bits=max_bits)))
    linked = distinct.join(stars, distinct["_fp"] == stars["_node"])
    least = linked.groupBy("_root").agg(F.min("_least").alias("_component"))
    named = linked.drop("_least").join(least, "_root").select("_node", "_component")
    return distinct.join(named, distinct["_fp"] == named["_node"], "left").select(
        F.col("_fp").alias("_key"), F.coalesce("_component", "_least").alias("_component")
    )


def near_duplicates(
    docs: DataFrame,
    *,
    words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, fingerprint, component_id) for every row.

    Fingerprints are 16 lower-case hex digits; they are linked at ``max_bits``
    or fewer differing bits, and a component is everything reachable over links.
    ``component_id`` is its smallest id; missing ids are passed over, and it is
    missing where a component has no id at all. Missing and empty texts have
    fingerprint zero and are linked like any other. Repeated rows stay. Other
    columns are not read. An empty table gives no rows.
    """
    prints = cut_lineage(fingerprints(docs, words=words, id_col=id_col, text_col=text_col))
    classes = _named_classes(prints, F.col("_doc"), max_bits)
    return prints.join(classes, prints["_fp"] == classes["_key"]).select(
        F.col("_doc").alias(id_col),
        F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"),
        F.col("_component").alias("component_id"),
    )


def keep_first(
    docs: DataFrame,
    *,
    words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row of each component, all columns untouched.

    The row with the smallest id stays, rows without an id come last, and among
    equal ids the text with the smallest hash. Of rows equal in id and text one
    stays.
    """
    named = docs.select(
        F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash")).alias("_row"),
        F.col(text_col).alias("_of_row"),
    )
    prints = cut_lineage(fingerprints(named, words=words, id_col="_row", text_col="_of_row"))
    row = F.col("_doc")
    value = F.struct(row["id"].isNull().alias("_no_id"), row["id"].alias("_id"), row["hash"].alias("_h"))
    key, hashed, own, n, won = free_names(docs.columns, "_key", "_hash", "_own", "_n", "_won")
    first = _named_classes(prints, value, max_bits).select(
        F.col("_component._id").alias("_i"), F.col("_component._h").alias("_h"), F.lit(True).alias(won)
    )
    # Thin rows decide; a text moves only where more is to go than can be sent to all tasks.
    keys = prints.groupBy(row["id"].alias(key), row["hash"].alias(hashed)).agg(F.count(F.lit(1)).alias(n))
    decided = cut_lineage(
        keys.join(first.distinct(), F.col(key).eqNullSafe(F.col("_i")) & (F.col(hashed) == F.col("_h")), "left")
    )
    same = F.col(id_col).eqNullSafe(F.col(key)) & (F.col(own) == F.col(hashed))
    kept = docs.withColumn(own, F.xxhash64(text_col)).join(
        _small(decided.where(F.col(won).isNull()).select(key, hashed)), same, "left_anti"
    )
    repeated = decided.where(F.col(won) & (F.col(n) > 1)).select(key, hashed)
    if repeated.isEmpty():
        return kept.select(*docs.columns)
    repeated = _small(repeated)
    # Of rows equal in id and text one stays, found map-side first however many they are.
    one = kept.join(repeated, same, "left_semi").groupBy(id_col, own)
    one = one.agg(F.first(F.struct(*docs.columns)).alias(key)).select(f"{key}.*")
    one = one.mapInArrow(lambda batches: batches, docs.schema)  # columns without NULL stay declared so
    return kept.join(repeated, same, "left_anti").select(*docs.columns).unionByName(one)


def _small(keys: DataFrame) -> DataFrame:
    """The thin rows, to be sent to all tasks while they are few."""
    return F.broadcast(keys) if keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS else keys
