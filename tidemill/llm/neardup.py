"""Near-duplicates by bottom-k sketches: inverted lists, union-sketch estimates, exact Jaccard, components."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.graph import components
from tidemill.llm.kernels import GRAM, PIECE_BYTES, as_bytes, gram_hashes, mix, pieces, text_words, word_hashes
from tidemill.session import cut

WORDS = 5
PERCENT = 85  # links have 100 * intersection >= PERCENT * union
KEPT = 48  # values of a sketch; a pair at the threshold shares fewer than half with a chance of about 1e-8
LIST = 32  # longest inverted list whose pairs are met one by one; longer ones go by hubs
ESTIMATE = 0.5  # least estimate; a pair at the threshold falls below it with a chance of about 2e-9
TILE = 256  # documents of one tile of a hub's group
TILE_GRAMS = 1 << 20  # and shingles of its sets, so that long documents make small tiles
BANDS = 20  # similarity to the hub, in steps of 1 / BANDS


def shingle_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The distinct 5-word shingles of each text as ascending 63-bit values; a text of fewer words is one shingle.

    Short texts are hashed together, a long one piece by piece; besides the sets, memory is bounded by the piece.
    """
    for low, high in pieces([len(t) for t in texts], PIECE_BYTES):
        if high - low == 1 and len(texts[low]) > 2 * PIECE_BYTES:
            yield _long_set(texts[low])
            continue
        docs, words = word_hashes([t.lower() for t in texts[low:high]])
        rows, grams = gram_hashes(docs, words, WORDS)
        edge = np.searchsorted(rows, np.arange(high - low + 1))
        word_edge = np.searchsorted(docs, np.arange(high - low + 1))
        for i in range(high - low):
            own = grams[edge[i] : edge[i + 1]]
            w = words[word_edge[i] : word_edge[i + 1]]
            yield _distinct(own if len(w) >= WORDS else _few_words(w))


def _few_words(words: np.ndarray) -> np.ndarray:
    if not len(words):
        return words
    return mix(np.array([np.sum(words * GRAM[: len(words)]) + np.uint64(len(words))], dtype=np.uint64))


def _distinct(grams: np.ndarray) -> np.ndarray:
    return np.unique(grams >> np.uint64(1)).view(np.int64)


def _long_set(text: bytes) -> np.ndarray:
    """The set of one text: the last words of a piece begin the next one; distinct values are merged as they double."""
    whole, fresh, waiting = np.zeros(0, np.int64), [], 0
    last = np.zeros(0, np.uint64)
    for words in text_words(text, lower=True, size=PIECE_BYTES):
        words = np.concatenate([last, words])
        fresh.append(_distinct(gram_hashes(np.zeros(len(words), np.int64), words, WORDS)[1]))
        last = words[-(WORDS - 1) :]
        waiting += len(fresh[-1])
        if waiting > len(whole) + PIECE_BYTES:
            whole, fresh, waiting = np.unique(np.concatenate([whole, *fresh])), [], 0
    whole = np.unique(np.concatenate([whole, *fresh]))
    return whole if len(whole) else _distinct(_few_words(last))


def _signature(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _sketches(batches):
    for b in batches:
        sizes, signatures, sketches = [], [], []
        for own in shingle_sets(as_bytes(b.column("text"))):
            sizes.append(len(own))
            signatures.append(_signature(own))
            sketches.append(own[:KEPT].copy())  # the rest of the set is not kept
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(signatures, pa.binary()),
             pa.array(sketches, pa.list_(pa.int64()))],
            names=["doc_id", "n", "sig", "sketch"],
        )


def _full_sets(batches):
    for b in batches:
        texts = as_bytes(b.column("text"))
        for low, high in pieces([len(t) for t in texts], 4 * PIECE_BYTES):
            sets = list(shingle_sets(texts[low:high]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([_signature(s) for s in sets], pa.binary()), pa.array(sets, pa.list_(pa.int64()))],
                names=["sig", "grams"],
            )


def linked(shared: Column, a: Column, b: Column) -> Column:
    return 100 * shared >= PERCENT * (a + b - shared)


def estimate(x: Column, y: Column) -> Column:
    """Jaccard similarity estimated on the sketch of the union: the part of its smallest values that both have."""
    union = F.slice(F.array_sort(F.array_union(x, y)), 1, KEPT)
    return F.size(F.array_intersect(F.array_intersect(x, y), union)) / F.size(union)


def _listed(classes: DataFrame) -> DataFrame:
    """`(value, node, n, k, place, df)`: the sketch values that two classes or more retain."""
    flat = classes.filter("n > 0").select(
        "node", "n", F.size("sketch").alias("k"), F.posexplode("sketch").alias("place", "value")
    )
    lists = flat.groupBy("value").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    return flat.join(lists, "value")


def _pairs_by_lists(entries: DataFrame, info: DataFrame) -> DataFrame:
    """`(a, b)` that share a value of a short list and may share half of their sketches."""
    short = entries.filter(F.col("df") <= LIST).select("value", "node").join(info, "node")
    left = short.select("value", *[F.col(c).alias(f"{c}_a") for c in ("node", "n", "k", "hot")])
    right = short.select("value", *[F.col(c).alias(f"{c}_b") for c in ("node", "n", "k", "hot")])
    fit = (100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b")) & (F.col("node_a") < F.col("node_b"))
    met = left.join(right, "value").filter(fit)
    overlap = met.groupBy("node_a", "node_b").agg(
        F.count(F.lit(1)).alias("o"), F.first(F.least("hot_a", "hot_b")).alias("hot"), F.first(F.least("k_a", "k_b")).alias("k")
    )
    return overlap.filter("2 * (o + hot) > k").select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))


def _hub_members(entries: DataFrame, info: DataFrame) -> DataFrame:
    """`(hub, node)` of the classes that may be linked over values of long lists alone.

    Such a link takes more than half of a sketch (of the shorter one, where sets are smaller than a sketch), all from
    long lists. So a class needs as many, and of its values of long lists, from the rarest on, all but the last
    that the link could do without: two linked classes have one of these in common. A text whose unshared part fills half of the sketch is not met at all,
    and values of a passage that many share come last. The hub of a value is the smallest of its classes.
    """
    full = F.col("n") * PERCENT >= KEPT * 100
    need = F.when(full, F.lit(KEPT // 2 + 1)).otherwise(F.floor(F.col("k") * PERCENT / 200) + 1)
    common = info.withColumn("spare", F.col("hot") - need).filter("spare >= 0").select("node", "spare")
    rarest = Window.partitionBy("node").orderBy("df", "value")
    long = entries.filter(F.col("df") > LIST).select("value", "node", "df").join(common, "node")
    keys = long.withColumn("__r", F.row_number().over(rarest)).filter(F.col("__r") <= F.col("spare") + 1).select("value", "node")
    # written tables, so the join deals both sides itself and can split the classes of a frequent value
    keys = cut(keys)
    hubs = cut(keys.groupBy("value").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("m")).filter("m > 1"))
    return keys.join(hubs, "value").select("hub", "node").distinct()


def _intersections(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """`pairs (a, b)` with `na`, `nb` and `shared`, counted on the full sets."""
    left = sets.select(F.col("node").alias("a"), F.col("grams").alias("ga"))
    right = sets.select(F.col("node").alias("b"), F.col("grams").alias("gb"))
    met = pairs.join(left, "a").join(right, "b")
    return met.select(
        "a", "b", F.size("ga").alias("na"), F.size("gb").alias("nb"), F.size(F.array_intersect("ga", "gb")).alias("shared")
    )


def _tile_links(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links between the documents of one or two tiles, as many as it takes to connect what is connected.

    Documents linked to the hub are connected through it already, so pairs of them are passed over.
    """
    pdf = pdf.sort_values(["side", "node"])
    nodes, sides, core = pdf["node"].to_numpy(), pdf["side"].to_numpy(), pdf["core"].to_numpy()
    sets = list(pdf["grams"])
    sizes = np.array([len(s) for s in sets])
    _, local = np.unique(np.concatenate(sets), return_inverse=True)
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    flags = np.zeros(local.max() + 1, dtype=np.int32)
    parent = list(range(len(nodes)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    two = sides.max() > 0
    out = []
    for i in range(len(nodes)):
        if two and sides[i]:
            break
        own = local[first[i] : first[i] + sizes[i]]
        low = int(np.searchsorted(sides, 1)) if two else i + 1
        if low >= len(nodes):
            break
        flags[own] = 1
        shared = np.add.reduceat(flags[local[first[low] :]], first[low:] - first[low])
        flags[own] = 0
        hit = 100 * shared >= PERCENT * (sizes[i] + sizes[low:] - shared)
        if core[i]:
            hit &= ~core[low:]
        for j in (np.flatnonzero(hit) + low).tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[a] = b
                out.append((nodes[i], nodes[j]))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def _hub_links(members: DataFrame, near: DataFrame, sets: DataFrame) -> DataFrame:
    """Links among the members of each hub that do not lead over the hub itself.

    Jaccard distance is a metric: documents whose similarities to the hub differ by more than 1 - PERCENT / 100 are
    not linked. Members are dealt into bands of similarity to the hub and those into tiles; only tiles of bands near
    enough meet, and tiles of documents that are linked to the hub do not meet each other.
    """
    shared = F.col("shared")
    similar = shared / (F.col("na") + F.col("nb") - shared)
    core = linked(shared, F.col("na"), F.col("nb"))
    # bands from the bottom; documents that are linked to the hub stand apart on top
    band = F.when(core, BANDS).otherwise(F.least(F.floor(similar * BANDS), F.lit(BANDS - 1))).cast("int")
    placed = near.select(F.col("a").alias("hub"), F.col("b").alias("node"), band.alias("band"), core.alias("core"), "nb")
    counts = placed.groupBy("hub", "band").agg(F.count(F.lit(1)).alias("m"), F.sum("nb").alias("grams"))
    counts = cut(counts.withColumn("tiles", F.ceil(F.greatest(F.col("m") / TILE, F.col("grams") / TILE_GRAMS)).cast("int")))
    placed = placed.join(counts.select("hub", "band", "tiles"), ["hub", "band"])
    placed = placed.withColumn("sub", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")).drop("tiles")
    tiles = counts.select("hub", "band", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("sub"))
    one = tiles.select("hub", F.col("band").alias("b1"), F.col("sub").alias("s1"))
    two = tiles.select("hub", F.col("band").alias("b2"), F.col("sub").alias("s2"))
    reach = -(-BANDS * (100 - PERCENT) // 100)
    # a core document may lie anywhere from the threshold up, that is in the bands from BANDS * PERCENT / 100 on
    floor_band = BANDS * PERCENT // 100
    low = F.least(F.col("b1"), F.lit(floor_band))
    meets = (
        (F.struct("b1", "s1") <= F.struct("b2", "s2"))
        & (F.least(F.col("b2"), F.lit(floor_band)) - low <= reach)
        & ~((F.col("b1") == BANDS) & (F.col("b2") == BANDS))
    )
    task = one.join(two, "hub").filter(meets)
    columns = ["hub", "b1", "s1", "b2", "s2", "node", "core"]
    sides = []
    for side, (b, t) in enumerate((("b1", "s1"), ("b2", "s2"))):
        other = task if side == 0 else task.filter("b1 <> b2 OR s1 <> s2")
        named = other.select("*", F.col(b).alias("band"), F.col(t).alias("sub"))
        sides.append(placed.join(named, ["hub", "band", "sub"]).select(*columns, F.lit(side).alias("side")))
    rows = sides[0].unionByName(sides[1])
    return (
        rows.join(sets, "node").groupBy("hub", "b1", "s1", "b2", "s2").applyInPandas(_tile_links, "a long, b long")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """`(doc_id, n_shingles, component_id, kept)`: one row per row of `docs`.

    A-Z are lower-cased and words are what lies between ASCII white space. A document's set are its distinct 5-word shingles;
    fewer words are one shingle, and documents without words (or with null text) have an empty set and are linked
    with nothing. `component_id` is the smallest `doc_id` that can be reached over links, `kept` says it is the
    document's own. Rows without `doc_id` take part but never name a component that has another one.

    Equal sets are one class before anything else happens. Each class retains the smallest hashes of its
    shingles. Classes that share a value of a short list are candidates; what remains of them after the estimate on the union's sketch
    is counted on the full sets. Classes with enough values of long lists to be linked over those alone meet by hubs
    (`_hub_links`), so a group of any size is split into tiles and its pairs are never written out. Nothing is capped.
    """
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = cut(plain.mapInArrow(_sketches, "doc_id long, n long, sig binary, sketch array<long>"))
    found = rows.groupBy("sig").agg(F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    classes = cut(found.withColumn("node", F.monotonically_increasing_id()))
    entries = cut(_listed(classes))
    info = cut(entries.groupBy("node", "n", "k").agg(F.sum((F.col("df") > LIST).cast("int")).alias("hot")))
    sketches = classes.select("node", "sketch")
    listed = _pairs_by_lists(entries, info)
    judged = (
        listed.join(sketches.select(F.col("node").alias("a"), F.col("sketch").alias("x")), "a")
        .join(sketches.select(F.col("node").alias("b"), F.col("sketch").alias("y")), "b")
        .filter(estimate(F.col("x"), F.col("y")) >= ESTIMATE).select("a", "b")
    )
    pairs = cut(judged)
    members = cut(_hub_members(entries, info))
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(members.select("node")).distinct()
    reps = cut(classes.join(wanted, "node", "left_semi").select("node", "sig", F.col("least").alias("__id")))
    texts = plain.join(reps.select("__id").distinct(), plain["doc_id"].eqNullSafe(F.col("__id")), "left_semi").select("text")
    full = texts.mapInArrow(_full_sets, "sig binary, grams array<long>").join(reps.select("node", "sig"), "sig")
    sets = cut(full.dropDuplicates(["node"]).select("node", "grams"))
    hub_pairs = members.select(F.col("hub").alias("a"), F.col("node").alias("b"))
    near = cut(_intersections(hub_pairs, sets))
    exact = _intersections(pairs, sets).unionByName(near).filter(linked(F.col("shared"), F.col("na"), F.col("nb")))
    links = cut(exact.select("a", "b").unionByName(_hub_links(members, near, sets)))
    roots = components(links)
    placed = classes.join(roots, "node", "left").select("node", "sig", "least", "n", F.coalesce("root", "node").alias("root"))
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = placed.join(named, "root").select("sig", "component_id")
    labelled = rows.select("doc_id", "n", "sig").join(of_class, "sig")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return labelled.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of `docs` whose `doc_id` names its component; rows that share a `doc_id` stay or go together."""
    stay = near_duplicates(docs).filter("kept").select("doc_id").distinct()
    # the given columns stay inside a struct, so none can clash with the key
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.join(stay, F.col("row.doc_id").cast("long").eqNullSafe(stay["doc_id"]), "left_semi").select("row.*")
