"""N-gram Jaccard join: size-banded tiles, hashed bitmap signatures, exact sorted-array intersection.

A document is the set of its distinct k-word shingles. Two link when 100 * |A and B| >= T * |A or B|.

1. **Sets.** One pass over whole texts makes each row's set (64-bit shingle fingerprints). Rows with
   the same set share one *node*, so copies never meet as pairs.
2. **Size-banded tiles.** Linked sets of sizes a <= b differ in at most k = (100-T)(a+b)/(100+T)
   shingles. A set is cut by hash into m parts, m the power of two over k for its size band (sets
   near the end of a band go into the next one, too); of m > k parts at least m - k are the same on
   both sides. (band, part, fingerprint of the part) is a tile. Beyond `tiles` parts only the first
   `tiles` are filed: a pair at the threshold then shares none with a chance under
   (1 - 1/e)^(0.9 tiles), 3e-9 for 48; below that the search is exact, empty parts included.
3. **Star rounds.** Every member of a tile is held against the tile's lead: the member that meets most
   others over all its tiles, which of a group of near copies is the least changed one (a maximum with
   partial aggregation, so a tile with a third of all rows is no hot task). Tiles that still hold
   members of different components get another lead. Large groups of near copies become one
   component here, in a number of pairs linear in the group.
4. **Block round.** Tiles that still hold members of different components are cut into blocks of
   about `block` rows, block meets block, and only pairs of different components that the bitmaps
   allow go on: |A and B| <= |A| - bits(A & ~B), and the same for B.
5. Pairs are verified by intersecting the sorted arrays; components of the links follow.

Only counts, node ids and links move, not texts; sets are made again for the nodes that share a tile.

Defined results: a null or empty text has an empty set and links with nothing (component: its own
doc_id); with fewer than k words the whole word sequence is the one shingle; rows with a null
doc_id take part, and a component's id is the smallest non-null doc_id in it; repeated rows give
repeated results; an empty table gives none. Fingerprints are 64 bits wide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import BROADCAST_ROWS, LOWER, Rolling, chunks, looked_up, mix, scratch, small_batches, small_side, store, utf8, word_spans
from tickerloom.llm.graph import components

ROLL = Rolling(9)
STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle fingerprints of every value of a string column."""
    data, bounds = utf8(column)
    for first, last in chunks(bounds):
        cut = bounds[first : last + 1]
        buf = LOWER[data[cut[0] : cut[-1]]]
        start, end, row = word_spans(buf, cut - cut[0])
        words = ROLL.runs(ROLL.prefix(buf), start, end)
        counts = np.bincount(row, minlength=last - first)
        ends = np.concatenate([[0], np.cumsum(counts)])
        rolled = words.copy()
        for j in range(1, k):
            rolled[: len(words) - j] = mix(rolled[: len(words) - j] * STEP + words[j:]) if len(words) > j else 0
        for i in range(last - first):
            a, b = ends[i], ends[i + 1]
            if b - a >= k:
                yield np.unique(rolled[a : b - k + 1])
            elif b > a:
                acc = np.full(1, b - a, np.uint64)
                for word in words[a:b]:
                    acc = mix(acc * STEP + word)
                yield acc
            else:
                yield np.zeros(0, np.uint64)


def _most_apart(total: int, percent: int) -> int:
    """Shingles in which two linked sets of `total` shingles together can differ."""
    return (100 - percent) * total // (100 + percent)


def _parts(size: int, percent: int) -> int:
    need, m = _most_apart(2 * size, percent) + 1, 1
    while m < need:
        m *= 2
    return m


def tile_keys(found: np.ndarray, percent: int, tiles: int) -> np.ndarray:
    """The tiles of a sorted set of fingerprints."""
    n = len(found)
    if n == 0:
        return np.zeros(0, np.uint64)
    largest = 100 * n // percent
    out = []
    m, top = _parts(n, percent), _parts(largest, percent)
    mixed = mix(found ^ STEP)
    while m <= top:
        part = ((found >> np.uint64(40)) & np.uint64(m - 1)).astype(np.int64)
        used = min(m, tiles)
        low = part < used
        total = np.zeros(used, np.uint64)
        np.add.at(total, part[low], mixed[low])
        filled = np.bincount(part[low], minlength=used) > 0
        if m <= tiles and (~filled).sum() >= m - min(_most_apart(n + largest, percent), m - 1):
            filled[:] = True  # so many empty parts that they could be the only ones shared
        at = np.flatnonzero(filled).astype(np.uint64)
        out.append(mix(total[filled] + mix(at * STEP + np.uint64(m))))
        m *= 2
    return np.concatenate(out)


def bitmap(found: np.ndarray, percent: int) -> np.ndarray:
    """A bitmap of the set in words of 64 bits; its width depends on the size band, up to 2^16 bits."""
    width = min(max(64, 16 * _parts(len(found), percent)), 1 << 16)
    bits = np.zeros(width, np.uint8)
    bits[((found >> np.uint64(8)) & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def node_of(found: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        total = np.add.reduce(found) * STEP + np.uint64(len(found))
        return int(mix(np.array([total ^ mix(np.array([np.bitwise_xor.reduce(mix(found ^ STEP))]))[0]]))[0].astype(np.int64))


def nodes_and_tiles(docs: DataFrame, k: int, percent: int, tiles: int) -> DataFrame:
    """doc_id, tkey (fingerprint of the text), n, node, tiles: a row per document, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            sizes, nodes, keys = [], [], []
            for found in shingle_sets(batch.column("text"), k):
                sizes.append(len(found))
                nodes.append(node_of(found))
                keys.append(tile_keys(found, percent, tiles).view(np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in keys])]).astype(np.int32)
            flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("tkey"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                ],
                ["doc_id", "tkey", "n", "node", "tiles"],
            )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tkey"), "text")
    return store(source.mapInArrow(run, "doc_id long, tkey long, n long, node long, tiles array<long>"))


def sets_of(docs: DataFrame, rows: DataFrame, wanted: DataFrame, k: int, percent: int) -> DataFrame:
    """node, n, bits, grams of the wanted nodes: one text of each is read again."""
    # Copies share a node: they are counted together before nodes are dealt out.
    one = rows.groupBy("node").agg(F.min(F.struct("tkey", "doc_id")).alias("r"))
    picked = store(one.join(wanted, "node", "left_semi").select("node", "r.tkey", F.col("r.doc_id").alias("pick")))
    texts = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tkey"), "text")
        .join(small_side(picked), "tkey").where(F.col("doc_id").eqNullSafe(F.col("pick"))).select("node", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found = list(shingle_sets(batch.column("text"), k))
            listed = lambda parts: pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)),
                pa.array(np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)),
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array([len(x) for x in found], pa.int64()), listed([bitmap(x, percent) for x in found]), listed(found)],
                ["node", "n", "bits", "grams"],
            )

    made = texts.mapInArrow(run, "node long, n long, bits array<long>, grams array<long>")
    return store(made.dropDuplicates(["node"]))


def _fold(x: Column, y: Column) -> Column:
    """`x` folded to half its width if it is wider than `y`: the bit of a hash is its low bits."""
    half = (F.size(x) / 2).cast("int")
    return F.when(
        F.size(x) > F.size(y), F.zip_with(F.slice(x, 1, half), F.slice(x, half + 1, half), lambda p, q: p.bitwiseOR(q))
    ).otherwise(x)


def bitmaps_allow(a: str, b: str, na: str, nb: str, percent: int) -> Column:
    """Whether the bit counts leave room for a link: an upper bound of the overlap, never too low."""
    x, y = _fold(F.col(a), F.col(b)), _fold(F.col(b), F.col(a))
    lost = lambda p, q: F.aggregate(
        F.zip_with(p, q, lambda s, t: F.bit_count(s.bitwiseAND(F.bitwise_not(t)))), F.lit(0), lambda s, t: s + t
    )
    most = F.least(F.col(na) - lost(x, y), F.col(nb) - lost(y, x))
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & ((100 + percent) * most >= percent * (F.col(na) + F.col(nb)))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rows of the stored `pairs` (a, b and more) that link: sizes and bitmaps first, then the intersection of the sorted arrays.

    Only sets that a pair asks for are dealt out, and arrays only for pairs that the bitmaps leave.
    """

    @F.pandas_udf("long")
    def common(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([len(np.intersect1d(a, b, assume_unique=True)) for a, b in zip(left, right)], dtype="int64")

    def side(s: str, asked: DataFrame, hint, *columns: str) -> DataFrame:
        ids = hint(asked.select(F.col(s).alias("node")).distinct())
        return sets.join(ids, "node", "left_semi").select(F.col("node").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in columns])

    def counted(asked: DataFrame):
        """Broadcast the ids that stored pairs ask for if the pairs are counted to be few."""
        return F.broadcast if asked.count() <= BROADCAST_ROWS else (lambda ids: ids)

    few = counted(pairs)
    near = store(
        pairs.join(side("a", pairs, few, "n", "bits"), "a").join(side("b", pairs, few, "n", "bits"), "b")
        .where(bitmaps_allow("bits_a", "bits_b", "n_a", "n_b", percent)).select(*pairs.columns, "n_a", "n_b")
    )
    few = counted(near)
    return (
        near.join(side("a", near, few, "grams"), "a").join(side("b", near, few, "grams"), "b")
        .select(*pairs.columns, "n_a", "n_b", common("grams_a", "grams_b").alias("both"))
        .where((100 + percent) * F.col("both") >= percent * (F.col("n_a") + F.col("n_b"))).select(*pairs.columns)
    )


def node_links(docs: DataFrame, rows: DataFrame, k: int, percent: int, block: int, star_rounds: int) -> DataFrame:
    """(node, label) of all nodes that share a tile with another node.

    `live` holds the members of tiles that still hold different labels, and only these go into the next round; what a
    round links are labels, so its components are those of the round's own few links.
    """
    filed = rows.select("node", F.explode("tiles").alias("tile"))
    shared = store(
        filed.groupBy("tile").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count("*").alias("size")).where("lo < hi")
    )
    met = store(filed.join(shared.select("tile", "size"), "tile").distinct())
    degrees = met.groupBy("node").agg(F.sum("size").alias("degree"))
    members = store(met.join(degrees, "node").select("tile", "node", "degree"))
    nodes = members.select("node").distinct()
    sets = sets_of(docs, rows, nodes, k, percent)
    label_pair = lambda x, y: (F.least(x, y).alias("p"), F.greatest(x, y).alias("q"))

    def joined(found: DataFrame) -> DataFrame:
        """(label, now): the labels that the links of `found` change."""
        links = found.select(F.col("p").alias("a"), F.col("q").alias("b")).distinct()
        return components(links).where("node <> label").select(F.col("node").alias("label"), F.col("label").alias("now"))

    live = members.select("tile", "node", "degree", F.col("node").alias("label"), F.lit(False).alias("led"))
    moves = []
    for _ in range(star_rounds):
        best = F.max_by(F.struct("node", "label"), F.struct("degree", "node")).alias("l")
        leads = store(live.where("not led").groupBy("tile").agg(best).select("tile", F.col("l.node").alias("lead"), F.col("l.label").alias("lead_label")))
        star = live.join(leads, "tile").where("label <> lead_label").select(
            F.least("lead", "node").alias("a"), F.greatest("lead", "node").alias("b"), *label_pair("label", "lead_label")
        )
        found = store(verified(store(star.distinct()), sets, percent))
        progress = found.limit(1).count() > 0
        if progress:
            moves.append(store(joined(found)))
            live = looked_up(live, moves[-1], "label", "node").withColumn("label", F.coalesce("now", "label")).drop("now")
        held = live.join(leads.select("tile", "lead"), "tile", "left").withColumn("led", F.col("led") | F.coalesce(F.col("node") == F.col("lead"), F.lit(False)))
        held = store(held.select("tile", "node", "degree", "label", "led"))
        mixed = held.groupBy("tile").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("size")).where("lo < hi")
        mixed_rows = store(held.join(mixed.select("tile", F.ceil(F.col("size") / block).cast("int").alias("blocks")), "tile"))
        live = mixed_rows.drop("blocks")
        if not progress or not live.limit(1).count():
            break

    if live.limit(1).count():
        # What has led its tile was held against all others there.
        open_ = mixed_rows.where("not led")
        # A node has a bounded number of tiles; a pair is taken in the first tile that both have.
        mine = open_.groupBy("node").agg(F.sort_array(F.collect_list("tile")).alias("mine"))
        own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
        laid = (
            open_.join(mine.join(sets.select("node", "n", "bits"), "node"), "node").withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("tile", "node", "label", "n", "bits", "mine", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
        )
        columns = ("node", "label", "n", "bits", "mine", "own")
        left, right = (laid.select("tile", "i", "j", *[F.col(c).alias(f"{c}_{s}") for c in columns]) for s in "ab")
        pairs = (
            left.join(right, ["tile", "i", "j"])
            .where("node_a < node_b and label_a <> label_b and (i = j or own_a <> own_b)")
            .where(F.get(F.array_intersect("mine_a", "mine_b"), F.lit(0)) == F.col("tile"))
            .where(bitmaps_allow("bits_a", "bits_b", "n_a", "n_b", percent))
            .select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), *label_pair("label_a", "label_b"))
        )
        found = store(verified(store(pairs), sets, percent))
        if found.limit(1).count():
            moves.append(store(joined(found)))

    labels = nodes.withColumn("label", F.col("node"))
    for move in moves:
        labels = looked_up(labels, move, "label", "node").select("node", F.coalesce("now", "label").alias("label"))
    return store(labels, outlive=True)


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, tiles: int = 48, block: int = 256, star_rounds: int = 4) -> DataFrame:
    """doc_id, tkey, n (set size), component (a key; null for an empty set), component_id: one row per row of `docs`."""
    with scratch(docs.sparkSession):
        rows = nodes_and_tiles(docs, k, percent, tiles)
        with scratch(docs.sparkSession):
            labels = node_links(docs, rows, k, percent, block, star_rounds)
        placed = store(
            looked_up(rows.select("doc_id", "tkey", "n", "node"), labels, "node", "doc_id")
            .select("doc_id", "tkey", "n", F.when(F.col("n") > 0, F.coalesce("label", "node")).alias("component")),
            outlive=True,
        )
        # Components of one row need no look-up.
        heads = placed.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("head"), F.count("*").alias("rows"))
        heads = store(heads.where("rows > 1"), outlive=True)
    grouped = F.col("rows").isNotNull()
    return looked_up(placed, heads, "component", "tkey").select(
        "doc_id", "tkey", "n", "component", F.when(grouped, F.col("head")).otherwise(F.col("doc_id")).alias("component_id"), "rows"
    )


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """`docs` with one row of every component: the one with the smallest doc_id (null last, then the text's fingerprint).

    Rows with an empty set all stay. All columns are kept as they are.
    """
    with scratch(docs.sparkSession):
        touched, again = _to_drop(docs, k, percent)
    keyed = docs.withColumns({"__tkey": F.xxhash64("text")})
    match = lambda v: keyed["doc_id"].eqNullSafe(v["doc_id"]) & (keyed["__tkey"] == v["tkey"])
    touched, again = small_side(touched), small_side(again)
    single = keyed.join(touched, match(touched), "left_anti").select(*docs.columns)
    repeated = keyed.join(again, match(again), "left_semi").dropDuplicates(["doc_id", "__tkey"]).select(*docs.columns)
    return single.unionByName(repeated)


def _to_drop(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, tkey) of all rows that go or are repeated, and of those repeated rows of which one stays."""
    found = near_duplicates(docs, k, percent).where("rows is not null")
    order = F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("d"), F.col("tkey").alias("t"))
    kept = store(found.groupBy("component").agg(F.min(order).alias("keep")))
    judged = looked_up(found, kept, "component", "tkey").select(
        "doc_id", "tkey", (F.col("doc_id").eqNullSafe(F.col("keep.d")) & (F.col("tkey") == F.col("keep.t"))).alias("kept")
    )
    # Rows are known by (doc_id, fingerprint of the text); rows that share both are repeats, of which one stays.
    verdict = store(judged.groupBy("doc_id", "tkey").agg(F.max("kept").alias("kept"), F.count("*").alias("repeats")))
    touched = store(verdict.where("not kept or repeats > 1").select("doc_id", "tkey"), outlive=True)
    return touched, store(verdict.where("kept and repeats > 1").select("doc_id", "tkey"), outlive=True)
