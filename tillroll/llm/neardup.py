"""Operator 2: near duplicates by ProbMinHash signatures, banding and verification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.components import components
from tillroll.llm.fingerprints import mixed
from tillroll.llm.tables import map_batches, share_code, table
from tillroll.operators.lookup import ROUND_BYTES, join_lookup, join_written, measured_bytes
from tillroll.scratch import job_folder, materialise, working_folder

WORDS = 5           # words of a shingle
SIMILARITY = 0.8    # least probability Jaccard similarity of the weighted shingles
BANDS, ROWS = 16, 4
REGISTERS = BANDS * ROWS
SKETCH_BITS = 4     # of each register, by which pairs are judged before their shingles are fetched
UNLIKE = 25         # registers in which a pair may differ there; 12 are expected of a pair of similarity 0.8
SMALL = 32          # nodes of a bucket up to which all of its open pairs are looked at at once
BLOCK = 512         # nodes of a larger bucket that are compared with as many others in one place
DAMPING = 16        # doublings of its count by which the weight of a shingle doubles
LEVELS = 3          # bands that part larger buckets, to find most of their links in linear time
SPLITS = 2          # ways in which a bucket is parted by a further band

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_CACHED_WORDS = 1 << 18


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_words = _WordHashes()


def shingles(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of the runs of ``WORDS`` lower-case words, and how often each occurs.

    Words are parted by ASCII white space. A shorter text is one shingle; a text without words has none.
    """
    words = (text or "").lower().encode("utf-8", "surrogatepass").split()
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    ids = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    size = min(WORDS, len(ids))
    total = np.full(len(ids) - size + 1, np.uint64(size))
    for shift in range(size):
        total = total * _GOLDEN + ids[shift:len(ids) - size + 1 + shift]
    return np.unique(mixed(total), return_counts=True)


def signatures(elements: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """ProbMinHash signatures of several weighted sets: one row of ``REGISTERS`` elements for each set.

    Set ``i`` is ``elements[starts[i]:starts[i + 1]]``, not empty. An element's points arrive as a Poisson process
    at the rate of its weight; each falls into a random register, which keeps the earliest. An element is done when
    its next point is later than all registers of its set. Two sets agree in a register with the probability
    Jaccard similarity of their weights.
    """
    sets = len(starts) - 1
    owner = np.repeat(np.arange(sets), np.diff(starts))
    times = np.full(sets * REGISTERS, np.inf)
    winners = np.zeros(sets * REGISTERS, np.uint64)
    active, clock, round_ = np.arange(len(elements)), np.zeros(len(elements)), 0
    while len(active):
        draw = mixed(elements[active] + np.uint64((2 * round_ + 1) * int(_GOLDEN) % (1 << 64)))
        uniform = ((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53
        clock = clock - np.log(uniform) / weights[active]
        slot = owner[active] * REGISTERS + (mixed(draw) % np.uint64(REGISTERS)).astype(np.int64)
        np.minimum.at(times, slot, clock)
        won = times[slot] == clock
        winners[slot[won]] = elements[active[won]]
        latest = times.reshape(sets, REGISTERS).max(axis=1)
        going = clock < latest[owner[active]]
        active, clock, round_ = active[going], clock[going], round_ + 1
    return winners.reshape(sets, REGISTERS)


def band_keys(found: np.ndarray) -> np.ndarray:
    """One hash per band of ``ROWS`` registers."""
    bands = found.reshape(len(found), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), bands.shape[:2]).copy()
    for row in range(ROWS):
        key = mixed(key * _GOLDEN + bands[:, :, row])
    return key


def weights_of(counts: np.ndarray) -> np.ndarray:
    """Damped counts: a shingle that is repeated weighs a little more than one that is not.

    So little that texts whose sets of shingles are alike stay so where only one of them repeats its lines.
    """
    return 1 + np.log2(counts) / DAMPING


def probability_jaccard(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> float:
    """What signatures estimate, exactly, for the sorted elements ``a`` of weights ``x`` and ``b`` of weights ``y``.

    The sum, over common elements i, of 1 / sum over all j of max(x_j / x_i, y_j / y_i). With equal weights it is the
    Jaccard similarity of the sets.
    """
    common, in_a, in_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    x_both, y_both = x[in_a], y[in_b]
    only_x, only_y = x.sum() - x_both.sum(), y.sum() - y_both.sum()
    found = 0.0
    # The inner sum depends on the ratio of the two weights of i only, of which there are few.
    ratios, of_ratio = np.unique(y_both / x_both, return_inverse=True)
    for k, ratio in enumerate(ratios):
        whole = np.maximum(x_both, y_both / ratio).sum() + only_x + only_y / ratio
        found += x_both[of_ratio == k].sum() / whole
    return float(found)


def sketches(found: np.ndarray) -> np.ndarray:
    """``SKETCH_BITS`` of each register, in 64-bit words."""
    per_word = 64 // SKETCH_BITS
    bits = (mixed(found) & np.uint64((1 << SKETCH_BITS) - 1)).reshape(len(found), -1, per_word)
    return np.bitwise_or.reduce(bits << (np.arange(per_word, dtype=np.uint64) * np.uint64(SKETCH_BITS)), axis=2)


def _signed(batch: dict[str, list]) -> dict[str, list]:
    nodes: list = [b"text" + text_id for text_id in batch["text_id"]]
    bands: list = [None] * len(nodes)
    drawn: list = [None] * len(nodes)
    # A few texts at a time keep the arrays in the processor's cache.
    for at in range(0, len(nodes), 64):
        sets = [(i, *shingles(batch["text"][i])) for i in range(at, min(at + 64, len(nodes)))]
        sets = [(i, elements, counts) for i, elements, counts in sets if len(elements)]
        if not sets:
            continue
        elements = np.concatenate([elements for _, elements, _ in sets])
        weights = weights_of(np.concatenate([counts for _, _, counts in sets]))
        starts = np.concatenate([[0], np.cumsum([len(elements) for _, elements, _ in sets])])
        found = signatures(elements, weights, starts)
        for (i, own, counts), keys, words in zip(sets, band_keys(found).view(np.int64), sketches(found).view(np.int64), strict=True):
            nodes[i] = hashlib.md5(own.tobytes() + counts.astype(np.int64).tobytes()).digest()
            bands[i], drawn[i] = keys, words
    longs = pa.list_(pa.int64())
    return {"text_id": batch["text_id"], "doc_id": batch["doc_id"], "node": nodes,
            "bands": pa.array(bands, longs), "sketch": pa.array(drawn, longs)}


def text_id(text: str = "text") -> Column:
    """128 bits that stand for a text; a null text is an empty one."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def unlike(one: Column, other: Column) -> Column:
    """In how many registers two sketches differ."""
    ones = F.lit(0x1111111111111111).cast("long")

    def differing(word: int) -> Column:
        x = F.get(one, F.lit(word)).bitwiseXOR(F.get(other, F.lit(word)))
        for shift in (1, 2):  # any bit of a register shows in its lowest one
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        return F.bit_count(x.bitwiseAND(ones))

    return sum((differing(word) for word in range(1, REGISTERS * SKETCH_BITS // 64)), differing(0))


def similar_texts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(texts, classes)`` of ``docs`` (doc_id, text), written tables: the node of each text, its least doc_id and its
    rows (text_id, node, doc_id, n), and the ``root`` of each node that resembles another.

    A node stands for all texts of the same shingles as often as they are there. Nodes of a probability Jaccard
    similarity of ``SIMILARITY`` or more are linked, and a class is what links connect. Candidates share a band
    of their signatures and differ in ``UNLIKE`` registers of their sketches at most; each is verified exactly.

    The work of the first rounds is linear in the rows of their buckets. In the first, the nodes of a bucket are compared
    with its leader, the one whose buckets are largest, as it resembles most. Of buckets whose nodes are not yet in one
    class, those of up to ``SMALL`` nodes have their open pairs compared, and larger ones are parted by each of
    ``SPLITS`` further bands, where there is a leader each again; so for ``LEVELS`` bands. These rounds only
    bring nodes together: in the last one all pairs of the larger buckets that are still in different classes are
    compared, however many, so that no candidate is passed over. Where these are ``BLOCK`` a row at most to begin with, no
    bucket is parted.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    prepared = docs.select(text_id().alias("text_id"), "doc_id", "text")
    signed = materialise(map_batches(
        prepared, _signed, f"text_id binary, doc_id {kind}, node binary, bands array<long>, sketch array<long>"))
    texts = materialise(signed.groupBy("text_id").agg(
        F.any_value("node").alias("node"), F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n")))
    nodes = materialise(signed.filter("bands is not null").groupBy("node").agg(
        F.min(F.struct("doc_id", "text_id")).alias("first"), F.any_value("bands").alias("bands"),
        F.any_value("sketch").alias("sketch")))

    members = nodes.select("node", F.posexplode("bands").alias("at", "bucket"))
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = materialise(join_written(members, materialise(sizes), "bucket"))
    scores = shared.groupBy("node").agg(F.sum("size").alias("score"))
    signs = materialise(scores.join(nodes, "node").select("node", "score", "bands", "sketch", "first"))
    level = materialise(shared.select("node", "at", "bucket").join(signs.drop("first").hint("merge"), "node"))

    found = _unseen(_with_leaders(level.withColumn("root", F.col("node"))), None)
    sets = materialise(_sets(prepared, signs))
    classes, seen, large = _merged(None, materialise(_verified(found, sets))), found, None
    for number in range(1, LEVELS + 1):
        placed = _placed(level, classes)
        parts = materialise(_open_buckets(placed))
        others = F.when(F.col("n") > SMALL, F.col("n") - F.col("main_n"))
        left = parts.agg(F.count(F.lit(1)).alias("buckets"), F.sum(others * F.col("n")).alias("pairs"),
                         F.sum(F.when(F.col("n") > SMALL, F.col("n"))).alias("rows")).first()
        if not left["buckets"]:
            break
        still = materialise(join_written(placed, parts, "bucket"))
        larger = still.filter(F.col("n") > SMALL)
        if large is None:
            large = larger.drop("score", "sketch")
            if (left["pairs"] or 0) <= BLOCK * (left["rows"] or 0):
                links = _verified(_unseen(_open_pairs(still.filter(F.col("n") <= SMALL)), seen), sets)
                if left["rows"]:
                    links = links.unionByName(_all_links(large, sets))
                return texts, _merged(classes, materialise(links))
        pairs = _open_pairs(still.filter(F.col("n") <= SMALL))
        if number < LEVELS:
            level = materialise(_parted(larger.drop("n", "main", "main_n")))
            pairs = pairs.unionByName(_with_leaders(level))
            level = level.drop("root")
        found = _unseen(pairs, seen)
        classes, seen = _merged(classes, materialise(_verified(found, sets))), seen.unionByName(found)
    if large is not None:
        placed = materialise(_placed(large.drop("root", "n", "main", "main_n"), classes))
        classes = _merged(classes, materialise(_all_links(
            join_written(placed, materialise(_open_buckets(placed)), "bucket"), sets)))
    return texts, classes


def _open_buckets(rows: DataFrame) -> DataFrame:
    """The buckets of ``rows`` (bucket, root) whose nodes are not in one class: their nodes ``n``, and the ``main`` class with
    most of them, ``main_n``."""
    counts = rows.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("bucket").agg(F.sum("n").alias("n"), F.max(F.struct("n", "root")).alias("most")).filter(
        "n > most.n").select("bucket", "n", F.col("most.root").alias("main"), F.col("most.n").alias("main_n"))


def _unseen(pairs: DataFrame, seen: DataFrame | None) -> DataFrame:
    """The different ``pairs`` that no earlier round has verified, a written table."""
    pairs = pairs.distinct()
    return materialise(pairs if seen is None else join_written(pairs, seen, ["a", "b"], "left_anti"))


def _placed(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """``rows`` with the ``root`` of their node so far."""
    return join_written(rows, classes, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _with_leaders(rows: DataFrame) -> DataFrame:
    """The leader of each bucket beside every node of it that is in another class and may resemble it."""
    leaders = materialise(rows.groupBy("bucket").agg(
        F.max(F.struct("score", "node", "root", "sketch")).alias("leader"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    near = (F.col("root") != F.col("leader.root")) & (unlike(F.col("sketch"), F.col("leader.sketch")) <= UNLIKE)
    return _ordered(join_written(rows, leaders, "bucket").filter(near), F.col("node"), F.col("leader.node"))


def _open_pairs(rows: DataFrame) -> DataFrame:
    """The pairs of nodes of a small bucket that are in different classes and may resemble each other."""
    one, other = (rows.select("bucket", *[F.col(name).alias(f"{side}_{name}") for name in ("node", "root", "sketch")])
                  for side in ("one", "other"))
    near = (
        (F.col("one_node") < F.col("other_node")) & (F.col("one_root") != F.col("other_root"))
        & (unlike(F.col("one_sketch"), F.col("other_sketch")) <= UNLIKE))
    return _ordered(one.join(other.hint("merge"), "bucket").filter(near), F.col("one_node"), F.col("other_node"))


def _all_links(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of a similarity of ``SIMILARITY`` or more among all pairs of ``rows`` of a bucket of any size
    (node, bucket, at, bands, root, and what ``_open_buckets`` has) that are in different classes; no sketch passes over one.

    The nodes of a bucket are dealt into blocks of about ``BLOCK``, those of its largest class apart from the others, and
    every block of others meets each block up to its own; so pairs within the largest class are never formed, and no
    task has to compare a bucket. Shingles travel with the blocks, not with the pairs.
    """
    inside, dealt = F.col("root") == F.col("main"), F.xxhash64("node")
    mains, others = F.ceil(F.col("main_n") / BLOCK), F.ceil((F.col("n") - F.col("main_n")) / BLOCK)
    own = rows.withColumns({"mains": mains, "others": others}).withColumn(
        "block", F.when(inside, F.pmod(dealt, "mains")).otherwise(F.col("mains") + F.pmod(dealt, "others")))
    own = materialise(own.join(sets.hint("merge"), "node"))
    kept = ["bucket", "node", "root", "at", "bands", "shingles", "counts"]
    ones = own.filter(~inside).select(
        *kept, F.col("block").alias("of"), F.explode(F.sequence(F.lit(0).cast("long"), "block")).alias("with"), F.lit(True).alias("first"))
    last = F.col("mains") + F.col("others") - 1
    others = own.select(*kept, F.col("block").alias("with"), F.explode(F.sequence(F.greatest("block", "mains"), last)).alias("of"),
                        F.lit(False).alias("first"))
    share_code(rows.sparkSession)
    return ones.unionByName(others).groupBy("bucket", "of", "with").applyInPandas(_linked, "a binary, b binary").distinct()


def _linked(rows: pd.DataFrame) -> pd.DataFrame:
    """The links between the first nodes and the others of two blocks that share no earlier band.

    Of a linked pair the common shingles have ``SIMILARITY`` of the weight of either, which is told for all others at once;
    the few that pass are verified.
    """
    ones, others = rows[rows["first"]], rows[~rows["first"]]
    found = []
    if len(ones) and len(others):
        at, alone = rows["at"].iloc[0], rows["of"].iloc[0] == rows["with"].iloc[0]
        names, ids = np.unique(np.concatenate(others["shingles"].tolist()), return_inverse=True)
        starts = np.concatenate([[0], np.cumsum(others["shingles"].map(len))[:-1]])
        y = weights_of(np.concatenate(others["counts"].tolist()))
        least = SIMILARITY * np.add.reduceat(y, starts) - 1e-9
        nodes, roots, bands = others["node"].to_numpy(object), others["root"].to_numpy(object), np.stack(others["bands"].tolist())[:, :at]
        sets = list(zip(others["shingles"], others["counts"], strict=True))
        for node, root, own, shingles_, counts in ones[["node", "root", "bands", "shingles", "counts"]].itertuples(index=False):
            x = weights_of(counts)
            place = np.minimum(np.searchsorted(names, shingles_), len(names) - 1)
            common = names[place] == shingles_
            mine = np.zeros(len(names))
            mine[place[common]] = x[common]
            both = mine[ids]
            likely = (np.add.reduceat(both, starts) >= SIMILARITY * x.sum() - 1e-9) & (
                np.add.reduceat(np.where(both > 0, y, 0), starts) >= least) & (roots != root) & ~(bands == own[:at]).any(axis=1)
            for k in np.flatnonzero(likely):
                if alone and not node < nodes[k]:
                    continue
                if probability_jaccard(shingles_, x, sets[k][0], weights_of(sets[k][1])) >= SIMILARITY - 1e-12:
                    found.append((min(node, nodes[k]), max(node, nodes[k])))
    return pd.DataFrame(found, columns=["a", "b"])


def _ordered(pairs: DataFrame, one: Column, other: Column) -> DataFrame:
    return pairs.select(F.least(one, other).alias("a"), F.greatest(one, other).alias("b"))


def _parted(rows: DataFrame) -> DataFrame:
    """The rows of buckets that are too large, in each of the buckets that a further band makes of them."""
    further = F.explode(F.array(*[F.lit(step) for step in range(1, SPLITS + 1)]))
    next_ = (F.col("at") + F.col("step")) % BANDS
    return (
        rows.withColumn("step", further).withColumn("next", next_)
        .withColumn("bucket", F.xxhash64("bucket", "step", F.get("bands", F.col("next"))))
        .withColumn("at", F.col("next")).drop("step", "next"))


def _sets(prepared: DataFrame, signs: DataFrame) -> DataFrame:
    """(node, shingles, counts) of the nodes that share a bucket, each from one of its texts."""
    wanted = materialise(signs.select("node", F.col("first.doc_id").alias("__doc_id"), F.col("first.text_id").alias("__text_id")))
    same = (F.col("text_id") == F.col("__text_id")) & F.col("doc_id").eqNullSafe(F.col("__doc_id"))
    # Where the wanted are few their size, which is measured, lets the texts of all others stay where they are.
    texts = join_lookup(prepared, wanted, same).select("node", "text").dropDuplicates(["node"])
    return map_batches(texts, _shingled, "node binary, shingles array<long>, counts array<int>")


def _shingled(batch: dict[str, list]) -> dict[str, list]:
    sets = [shingles(text) for text in batch["text"]]
    return {"node": batch["node"], "shingles": pa.array([elements.view(np.int64) for elements, _ in sets], pa.list_(pa.int64())),
            "counts": pa.array([counts.astype(np.int32) for _, counts in sets], pa.list_(pa.int32()))}


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of a similarity of ``SIMILARITY`` or more."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("a_set"), F.col("counts").alias("a_counts"))
    other = sets.select(F.col("node").alias("b"), F.col("shingles").alias("b_set"), F.col("counts").alias("b_counts"))
    if measured_bytes(pairs) <= ROUND_BYTES:  # then shingles that no pair needs stay where they are
        one, other = (side.join(F.broadcast(pairs.select(end)), end, "left_semi") for side, end in ((one, "a"), (other, "b")))
    share_code(pairs.sparkSession)
    # A leader's side may be hot; the pairs are then as many rows, and adaptive execution splits them.
    return pairs.join(other.hint("merge"), "b").join(one.hint("merge"), "a").mapInArrow(_similar, "a binary, b binary")


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(name)) for name in ("a_set", "a_counts", "b_set", "b_counts")]
        kept = []
        for row in range(batch.num_rows):
            a, x, b, y = (column[row].values.to_numpy() for column in columns)
            likeness = probability_jaccard(a.view(np.uint64), weights_of(x), b.view(np.uint64), weights_of(y))
            kept.append(likeness >= SIMILARITY - 1e-12)
        yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))


def _merged(classes: DataFrame | None, links: DataFrame) -> DataFrame:
    """The classes (node, root) so far, joined by further links: only roots and new nodes are gone through."""
    if classes is None:
        return materialise(components(links))
    if links.isEmpty():
        return classes
    size = measured_bytes(classes)
    root_of = classes.select(F.col("node").alias("__node"), F.col("root").alias("__root"))
    for end in ("a", "b"):
        links = join_written(links, root_of, F.col(end) == F.col("__node"), "left", size=size).withColumn(
            end, F.coalesce("__root", end)).drop("__node", "__root")
    joined = materialise(components(links))
    moved = joined.select(F.col("node").alias("__node"), F.col("root").alias("__root"))
    old = join_written(classes, moved, F.col("root") == F.col("__node"), "left").select(
        "node", F.coalesce("__root", "root").alias("root"))
    new = join_written(joined, classes.select("node"), "node", "left_anti", size=size)
    return materialise(old.unionByName(new))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, class_size, is_kept) for each row of ``docs`` (doc_id, text).

    Rows of one class hold equal texts, or texts joined by a chain of near duplicates. ``class_id`` is the least
    doc_id of the class (null if all are null) and ``is_kept`` marks the rows with that id. Texts without words, null
    ones among them, resemble only equal texts. Repeated rows are in one class. No rows: no rows.
    """
    rows = docs.select("doc_id", text_id().alias("text_id"))
    joined = rows.join(text_classes(docs).hint("merge"), "text_id")
    return joined.select("doc_id", "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("is_kept"))


def text_classes(docs: DataFrame) -> DataFrame:
    """(text_id, class_id, class_size, keeper) for each different text, a written table.

    ``keeper`` (doc_id, text_id) is the class's least doc_id and the text of the row that has it.
    """
    target = working_folder(docs.sparkSession) + "/classes"
    with job_folder(docs.sparkSession):  # which goes with all tables of the rounds
        return materialise(_text_classes(docs), target)


def _text_classes(docs: DataFrame) -> DataFrame:
    texts, found = similar_texts(docs)
    rooted = materialise(_placed(texts, found).drop("node"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_id"))
    classes = materialise(rooted.groupBy("root").agg(first.alias("keeper"), F.sum("n").alias("class_size")))
    return (rooted.select("text_id", "root").join(classes.hint("merge"), "root").select(
        "text_id", F.col("keeper.doc_id").alias("class_id"), "class_size", "keeper"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each class of ``near_duplicates``: that of the least doc_id; of rows equal in it, one."""
    kept = text_classes(docs).filter("text_id = keeper.text_id").select(
        F.col("text_id").alias("__text_id"), F.col("class_id").alias("__class_id"))
    own = docs.withColumn("__own_id", text_id())
    same = (F.col("__own_id") == F.col("__text_id")) & F.col("doc_id").eqNullSafe(F.col("__class_id"))
    return own.join(kept.hint("merge"), same, "left_semi").dropDuplicates(["__own_id", "doc_id"]).select(*docs.columns)


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
