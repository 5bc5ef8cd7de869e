"""Near-duplicate groups from bottom-k sketches of word shingles.

A text's set holds the 64-bit hashes of its distinct shingles; its sketch is the
``sketch`` smallest of them, all under the one hash function. Texts with the same
set form one class, whatever their number, and only classes go on.

1. Inverted lists: value -> classes that retain it. Two sets of similarity t share
   no retained value with probability (1 - t)^sketch.
2. Lists of at most ``list_max`` classes give all their pairs (a bounded number per
   entry); the overlap of a pair is the number of lists it meets in.
3. A longer list (a passage in many texts, a text with very many variants) gives
   no pairs of its own. Two classes can only be similar without sharing a value
   of a short list if both consist almost wholly of values of long lists; a class
   with more other values in its sketch than two similar sets can differ by (but for
   one pair in 10^9, by the binomial distribution) is not such a class. The few that are
   get compared, in every long list and size band they are in, with its leader: the member
   with the most values of long lists (of these the one with most rows), which is nearest to
   what all have in common and mostly the same one in all lists of a group of variants, so
   such a group gives a few pairs a class, whatever its size. What the leaders miss is left to 5 and 7.
4. The union sketch (the smallest ``sketch`` values of both sketches) estimates the
   similarity; pairs with fewer agreements than one similar pair in 10^9 has are dropped.
5. The classes of step 3 go through steps 1 to 3 once more with their full sets for
   sketches, so what two of them have in common beside the long lists is found.
6. Pairs are decided on the full sets. Components of these links, by hooking onto the
   smallest neighbour and contracting, are the groups so far.
7. Classes still made of long lists are compared exactly. Two of them that have met in no
   short list have all they share in values of long lists, and reach the threshold only if
   they share one among the rarest of these in both (prefix filter), hence also the leader
   of that value's list. So a class belongs to the parts of the few leaders of its rarest
   values. Jaccard distance is a metric: two classes of a part are only compared where their
   distances to the leader differ by no more than the threshold allows, which a grid of
   distance cells tells, and only classes of different groups are, so a large group of
   variants costs nothing here. Cells are cut into chunks and compared chunk against chunk
   inside a task: no candidate pairs are written. New links join the groups.

Cases: null, empty and white-space texts have no shingle, are linked with nothing and
kept; a text with fewer words than a shingle is one shingle of all its words; of rows
with equal ids each is judged by its own text, and each row whose id is its group's
smallest is kept; a null id is larger than any id; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from flowlog.llm.common import U64, as_bytes, hash_words, discard, lower_words, materialise, mix, release_memory, ship_package

SKETCH = 32
LIST_MAX = 32
MISSED = 1e-9           # chance that a sketch hides a similar pair
CELLS = 20              # distance cells along a part's leader, each 1 / CELLS wide
CHUNK = 1024            # classes of a cell that are compared at once with as many others,
CHUNK_VALUES = 400_000  # and values of their sets
BROADCAST_IDS = 1_000_000       # candidate ids that may be broadcast (16 MB); more are joined by shuffling
_SLICE = 1 << 20


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text, as signed 64-bit integers."""
    places: dict[bytes, int] = {}
    docs = [np.array([places.setdefault(w, len(places)) for w in lower_words(t)], dtype=np.int64) for t in texts]
    names = hash_words(list(places), 3)
    out = []
    for at in docs:
        if not len(at):
            out.append(np.zeros(0, np.int64))
            continue
        level = names[at]
        for k in range(1, min(width, len(at))):
            level = mix(level[:-1], names[at[k:]])
        if len(at) < width:
            level = level ^ U64(len(at))
        out.append(np.unique(level.view(np.int64)))
    return out


def _class_of(shingles: np.ndarray) -> int:
    both = shingles.view(np.uint64)
    return int(mix(np.array([both.sum()]), np.array([np.bitwise_xor.reduce(mix(both, both))])).view(np.int64)[0])


def _slices(values: list[bytes]):
    start, held = 0, 0
    for i, v in enumerate(values):
        if held and held + len(v) > _SLICE:
            yield start, i
            start, held = i, 0
        held += len(v)
    if start < len(values):
        yield start, len(values)


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int, sketch: int) -> DataFrame:
    """Per row: id, ``n_shingles``, ``cls`` (64-bit name of the set, null if empty) and ``sketch``."""
    def run(batches):
        for batch in batches:
            values = as_bytes(batch.column(text_col))
            for a, b in _slices(values):
                sets = shingle_sets(values[a:b], width)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(id_col).slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([_class_of(s) if len(s) else None for s in sets], pa.int64()),
                     pa.array([s[:sketch] for s in sets], pa.list_(pa.int64()))], names=[id_col, "n_shingles", "cls", "sketch"])
            batch = values = sets = None
            release_memory()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_shingles long, cls long, sketch array<long>")


def full_sets(docs: DataFrame, text_col: str, width: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            values = as_bytes(batch.column(text_col))
            for a, b in _slices(values):
                sets = [s for s in shingle_sets(values[a:b], width) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([_class_of(s) for s in sets], pa.int64()),
                                                  pa.array(sets, pa.list_(pa.int64()))], names=["cls", "shingles"])
            batch = values = sets = None
            release_memory()

    return docs.select(text_col).mapInArrow(run, "cls long, shingles array<long>")


def shared_values(classes: DataFrame) -> DataFrame:
    """Inverted lists of two classes or more, as rows (value, cls, n, copies, k, listed)."""
    postings = classes.select("cls", "n", "copies", F.size("sketch").alias("k"), F.explode("sketch").alias("value"))
    lists = postings.groupBy("value").agg(F.count("*").alias("listed")).where("listed > 1")
    return postings.join(lists, "value")


def short_list_pairs(shared: DataFrame, percent: int, list_max: int) -> DataFrame:
    return (shared.where(F.col("listed") <= list_max).groupBy("value").agg(F.collect_list(F.struct("cls", "n")).alias("m"))
            .select(F.explode(F.expr(
                "flatten(transform(m, x -> transform(filter(m, y -> y.cls > x.cls"
                f" and 100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)), y -> struct(x.cls as a, y.cls as b))))")).alias("p"))
            .groupBy("p.a", "p.b").agg(F.count("*").alias("overlap")))


def most_apart(sketch: int, percent: int) -> int:
    """Values of a sketch in which sets at the threshold differ at most, but for one pair in 1 / MISSED."""
    p, tail, k = 1 - percent / 100, 0.0, sketch
    while k > 0:
        tail += math.comb(sketch, k) * p ** k * (1 - p) ** (sketch - k)
        if tail > MISSED:
            return k
        k -= 1
    return 0


def common_classes(shared: DataFrame, percent: int, list_max: int, sketch: int | None) -> DataFrame:
    """Classes made almost wholly of values of long lists, with the number of these values. With ``sketch``
    the lists hold sketches, else whole sets; sets so small that all similar ones fit a sketch are whole too."""
    whole = 100 * (F.col("kk") - F.col("common")) <= (100 - percent) * F.col("kk")
    if sketch:
        whole = F.when(100 * F.col("kk") <= percent * sketch, whole).otherwise(F.col("kk") - F.col("common") <= most_apart(sketch, percent))
    return (shared.where(F.col("listed") > list_max).groupBy("cls").agg(F.count("*").alias("common"), F.max("k").alias("kk"))
            .where(whole).select("cls", "common"))


def leader_pairs(shared: DataFrame, common: DataFrame, percent: int, list_max: int) -> DataFrame:
    """Members of long lists with the leader of their list, in their own size band and the next ones."""
    band = F.floor(F.log("n") / math.log(100 / percent)).cast("int")
    member = (shared.where(F.col("listed") > list_max).join(common, "cls")
              .select("value", "cls", "common", "copies", band.alias("band")))
    leaders = (member.groupBy("value", "band").agg(F.max_by("cls", F.struct("common", "copies", "cls")).alias("leader"))
               .select("value", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"), "leader"))
    return (member.join(leaders, ["value", "band"]).where(F.col("cls") != F.col("leader"))
            .groupBy(F.least("cls", "leader").alias("a"), F.greatest("cls", "leader").alias("b")).agg(F.count("*").alias("overlap")))


def likely_pairs(pairs: DataFrame, classes: DataFrame, percent: int, sketch: int) -> DataFrame:
    """Pairs whose union sketch does not rule the threshold out."""
    sk = classes.select("cls", "n", "sketch")
    both = (pairs.join(sk.toDF("a", "na", "sa"), "a").join(sk.toDF("b", "nb", "sb"), "b")
            .where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
            .withColumn("u", F.slice(F.array_sort(F.array_union("sa", "sb")), 1, sketch)))
    agreed = F.size(F.array_intersect(F.array_intersect("sa", "sb"), "u"))
    # a union that does not fill a sketch is known as a whole
    enough = F.when(F.size("u") < sketch, 100 * agreed >= percent * F.size("u")).otherwise(agreed >= sketch - most_apart(sketch, percent))
    return both.where(enough).select("a", "b", "na", "nb")


def sets_of(docs: DataFrame, wanted: DataFrame, classes: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """Full sets of the wanted classes, read again from the text of the row with their smallest id."""
    ids = wanted.select("cls").distinct().join(classes.select("cls", "least_id"), "cls").select(F.col("least_id").alias("want_id")).distinct()
    few = ids.count() <= BROADCAST_IDS
    texts = docs.select(id_col, text_col).join(F.broadcast(ids) if few else ids, F.col(id_col).eqNullSafe(F.col("want_id")), "left_semi")
    return full_sets(texts, text_col, width).groupBy("cls").agg(F.max("shingles").alias("shingles"))


def verified_links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs that reach the threshold on their full sets."""
    both = pairs.select("a", "b").join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    inter = F.col("inter")
    return (both.withColumn("inter", F.size(F.array_intersect("sa", "sb")))
            .where(100 * inter >= percent * (F.size("sa") + F.size("sb") - inter)).select("a", "b"))


def leader_parts(again: DataFrame, still: DataFrame, found: DataFrame, classes: DataFrame, percent: int, list_max: int) -> DataFrame:
    """Classes made of long lists by the leaders of their rarest values: rows (part, cls, n, part_of, main), parts of one group left out."""
    long = again.where(F.col("listed") > list_max).join(still, "cls").select("cls", "n", "copies", "common", "listed", "value")
    leaders = long.groupBy("value").agg(F.max_by("cls", F.struct("common", "copies", "cls")).alias("part"))
    # of n values at least percent are shared, all in long lists: the first shared one has at most n - shared long ones before it
    first = F.size("m") - F.ceil(F.col("n") * percent / F.lit(100)).cast("int") + 1
    rarest = (long.groupBy("cls").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("listed", "value"))).alias("m"))
              .withColumn("first", first).where("first > 0").select("cls", "n", F.explode(F.expr("slice(m, 1, first)")).alias("x")))
    rows = rarest.select("cls", "n", F.col("x.value").alias("value")).join(leaders, "value").select("part", "cls", "n").distinct()
    named = classes.select("cls", "least_id").join(found, "cls", "left").select(
        "cls", F.struct(F.coalesce("component", "least_id").alias("id"), F.when(F.col("component").isNull(), F.col("cls")).alias("own")).alias("part_of"))
    rows = materialise(rows.join(named, "cls").withColumn("part_of", F.xxhash64("part_of.id", "part_of.own")), "near-parts")
    mixed = (rows.groupBy("part", "part_of").agg(F.count("*").alias("c")).groupBy("part")
             .agg(F.max_by("part_of", F.struct("c", "part_of")).alias("main"), F.count("*").alias("groups")).where("groups > 1").select("part", "main"))
    return rows.join(mixed, "part")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all left with all right sets. Values in many sets are multiplied as columns
    of a matrix, the others counted pair by pair."""
    nl, nr = len(left), len(right)
    out = np.zeros(nl * nr, np.float64)
    known, place = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    owner = np.repeat(np.arange(nl + nr), [len(x) for x in (*left, *right)])
    side = owner < nl
    in_left, in_right = np.bincount(place[side], minlength=len(known)), np.bincount(place[~side], minlength=len(known))
    work = in_left * in_right
    dense = np.flatnonzero(work * 256 > nl * nr)
    for a in range(0, len(dense), 4096):
        column = np.full(len(known), -1)
        column[dense[a:a + 4096]] = np.arange(len(dense[a:a + 4096]))
        both = np.zeros((nl + nr, len(dense[a:a + 4096])), np.float32)
        hit = column[place] >= 0
        both[owner[hit], column[place[hit]]] = 1
        out += (both[:nl] @ both[nl:].T).ravel()
    rest = work > 0
    rest[dense] = False
    order = np.argsort(place, kind="stable")            # of each value first its left owners, then its right ones
    starts = np.cumsum(in_left + in_right) - (in_left + in_right)
    values = np.flatnonzero(rest)
    ends = np.cumsum(work[values])
    for a, b in _runs(ends, 1 << 22):
        v = values[a:b]
        pair = np.arange(int(work[v].sum())) - np.repeat(np.cumsum(work[v]) - work[v], work[v])
        width = np.repeat(in_right[v], work[v])
        at = np.repeat(starts[v], work[v])
        x, y = owner[order[at + pair // width]], owner[order[at + np.repeat(in_left[v], work[v]) + pair % width]] - nl
        out += np.bincount(x * nr + y, minlength=nl * nr)
    return out.reshape(nl, nr)


def _runs(ends: np.ndarray, most: int):
    """Runs of places whose work adds up to about ``most``."""
    at = 0
    while at < len(ends):
        done = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield at, to
        at = to


def tile_links(table: pa.Table, percent: int) -> pa.Table:
    """Links between the left and right classes of one tile: of each left class one with every group that it reaches."""
    is_left = np.array(table.column("is_left").to_pylist(), dtype=bool)
    cls, group = (table.column(c).to_numpy() for c in ("cls", "part_of"))
    sets = [np.asarray(x, np.int64) for x in table.column("shingles").to_pylist()]
    l, r = np.flatnonzero(is_left), np.flatnonzero(~is_left)
    found = []
    if len(l) and len(r):
        sizes = np.array([len(x) for x in sets])
        inter = overlaps([sets[i] for i in l], [sets[i] for i in r])
        union = sizes[l][:, None] + sizes[r][None, :] - inter
        x, y = np.nonzero((100 * inter >= percent * union) & (group[l][:, None] != group[r][None, :]))
        _, at = np.unique(np.stack([x, group[r][y]], axis=1), axis=0, return_index=True)
        found = [(int(cls[l[i]]), int(cls[r[j]])) for i, j in zip(x[at].tolist(), y[at].tolist())]
    return pa.table({"a": pa.array([min(p) for p in found], pa.int64()), "b": pa.array([max(p) for p in found], pa.int64())})


def exact_links(parts: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different groups of the same part. A part's largest group is not compared with itself."""
    # cell by the exact distance to the part's leader
    placed = (parts.join(sets, "cls").join(sets.toDF("part", "leader"), "part")
              .withColumn("cell", F.expr(f"cast(({CELLS} * (size(shingles) + size(leader) - 2 * size(array_intersect(shingles, leader)))) "
                                         "div (size(shingles) + size(leader) - size(array_intersect(shingles, leader))) as int)"))
              .select("part", "cell", "cls", "n", "part_of", (F.col("part_of") != F.col("main")).alias("is_left"), "shingles"))
    placed = materialise(placed, "near-cells")

    def chunks(rows, values):
        return F.greatest(F.ceil(rows / CHUNK), F.ceil(values / CHUNK_VALUES), F.lit(1)).cast("int")

    cells = (placed.groupBy("part", "cell").agg(F.count("*").alias("rows"), F.sum("n").alias("values"), F.sum(F.col("is_left").cast("long")).alias("left_rows"),
                                                F.sum(F.when(F.col("is_left"), F.col("n")).otherwise(0)).alias("left_values")))
    cells = materialise(cells.select("part", "cell", "left_rows", chunks(F.col("left_rows"), F.col("left_values")).alias("lchunks"),
                                     chunks(F.col("rows"), F.col("values")).alias("rchunks")), "near-cell-sizes")
    # cells further apart than ``reach`` hold no two classes within the threshold
    reach = -(-CELLS * (100 - percent) // 100)
    lefts = cells.where("left_rows > 0").select("part", F.col("cell").alias("lcell"), F.explode(F.sequence(F.lit(0), F.col("lchunks") - 1)).alias("lchunk"))
    rights = cells.select("part", F.col("cell").alias("rcell"), F.explode(F.sequence(F.lit(0), F.col("rchunks") - 1)).alias("rchunk"))
    tiles = lefts.join(rights, "part").where(F.abs(F.col("lcell") - F.col("rcell")) <= reach)
    sized = placed.join(cells.select("part", "cell", "lchunks", "rchunks"), ["part", "cell"])
    tile = ["part", "lcell", "lchunk", "rcell", "rchunk"]
    left = (sized.where("is_left").withColumn("lchunk", F.pmod(F.xxhash64("cls"), F.col("lchunks")).cast("int")).withColumnRenamed("cell", "lcell")
            .join(tiles, ["part", "lcell", "lchunk"]).select(*tile, F.lit(True).alias("is_left"), "cls", "part_of", "shingles"))
    right = (sized.withColumn("rchunk", F.pmod(F.xxhash64("cls"), F.col("rchunks")).cast("int")).withColumnRenamed("cell", "rcell")
             .join(tiles, ["part", "rcell", "rchunk"]).select(*tile, F.lit(False).alias("is_left"), "cls", "part_of", "shingles"))
    return left.unionByName(right).groupBy(*tile).applyInArrow(lambda t: tile_links(t, percent), "a long, b long").distinct()


def components(links: DataFrame, classes: DataFrame) -> DataFrame:
    """(cls, component): the smallest id of the classes reachable over links.

    Every class hooks onto its smallest neighbour, links are renamed to what their ends hooked onto, and
    those that have become loops or equal to others go; so a large group shrinks to few links in a round
    or two, and only its first round reads all of them.
    """
    edges = links.select("a", "b").distinct()
    home = None
    while True:
        ends = edges.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(edges.select(F.col("b").alias("x"), F.col("a").alias("y")))
        hook = materialise(ends.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("h")), "near-hooks")
        if home is None:
            after = hook.select(F.col("x").alias("cls"), F.col("h").alias("root"))
        else:
            after = home.join(hook, F.col("root") == F.col("x"), "left").select("cls", F.coalesce("h", "root").alias("root"))
        after = materialise(after, "near-homes")
        renamed = (edges.join(hook.toDF("a", "ha"), "a").join(hook.toDF("b", "hb"), "b").where("ha <> hb")
                   .select(F.least("ha", "hb").alias("a"), F.greatest("ha", "hb").alias("b")).distinct())
        left = materialise(renamed, "near-edges")
        discard(hook)
        if home is not None:
            discard(home)
            discard(edges)
        home, edges = after, left
        if edges.isEmpty():
            break
    least = F.min(F.struct(F.col("least_id").isNull().alias("none"), F.col("least_id").alias("id")))
    named = home.join(classes.select("cls", "least_id"), "cls")
    return named.select("cls", "root").join(named.groupBy("root").agg(least.alias("m")), "root").select("cls", F.col("m.id").alias("component"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80,
                sketch: int = SKETCH, list_max: int = LIST_MAX) -> DataFrame:
    """Per row of ``docs``: id, ``cls``, ``n_shingles``, ``component_id`` and ``kept``."""
    ship_package(docs.sparkSession)
    per_row = materialise(sketches(docs, id_col, text_col, width, sketch), "near-sketches")
    classes = materialise(per_row.where("n_shingles > 0").groupBy("cls")
                          .agg(F.min(id_col).alias("least_id"), F.max("n_shingles").alias("n"), F.max("sketch").alias("sketch"),
                               F.count("*").alias("copies")), "near-classes")
    shared = materialise(shared_values(classes), "near-lists")
    common = common_classes(shared, percent, list_max, sketch)
    met = short_list_pairs(shared, percent, list_max).unionByName(leader_pairs(shared, common, percent, list_max))
    met = met.groupBy("a", "b").agg(F.sum("overlap").alias("overlap"))
    pairs = materialise(likely_pairs(met, classes, percent, sketch), "near-pairs")
    common = materialise(common, "near-common")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("cls")).unionByName(common.select("cls"))
    sets = materialise(sets_of(docs, wanted, classes, width, id_col, text_col), "near-sets")
    # the classes made of long lists once more, by all their values instead of a sketch
    whole = classes.join(common.select("cls"), "cls").join(sets, "cls").select("cls", "n", "copies", F.col("shingles").alias("sketch"))
    again = materialise(shared_values(whole), "near-lists")
    still = common_classes(again, percent, list_max, None)
    more = short_list_pairs(again, percent, list_max).unionByName(leader_pairs(again, still, percent, list_max))
    links = verified_links(pairs.select("a", "b").unionByName(more.select("a", "b")).distinct(), sets, percent)
    links = materialise(links, "near-links")
    found = components(links, classes)
    # what is still made of long lists: every pair of different groups that can reach the threshold
    parts = materialise(leader_parts(again, still, found, classes, percent, list_max), "near-mixed-parts")
    if not parts.isEmpty():
        extra = materialise(exact_links(parts, sets, percent), "near-links")
        if not extra.isEmpty():
            found = components(links.unionByName(extra), classes)
    named = (classes.select("cls", "least_id").join(found, "cls", "left")
             .select("cls", F.coalesce("component", "least_id").alias("component")))
    rows = per_row.select(id_col, "cls", "n_shingles").join(named, "cls", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col(id_col))
    return rows.select(id_col, "cls", "n_shingles", component.alias("component_id"),
                       F.col(id_col).eqNullSafe(component).alias("kept"))
