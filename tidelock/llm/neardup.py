"""MinHash near-duplicates with odd sketches.

1. A document is the set of its word shingles; documents with equal sets are one class, which a digest of the whole
   set names, so copies are never compared.
2. Classes meet in buckets by bands of their MinHash samples.  A band of 5 of 160 samples leaves two sets of
   similarity 0.85 apart in all 32 bands once in 10**8 pairs, at 0.8 three times in 10**6.
3. The samples are also folded into an odd sketch, a bitmap of parities.  The XOR of two sketches counts the samples
   in which two sets differ, which tells high similarities apart well; it refuses pairs far below the threshold.
4. Every bucket has a hub.  Its members are compared with it on full sets, which joins nearly all of them in a number
   of comparisons that is linear in the bucket.
5. Buckets that still hold several components are searched for the rest: the members outside of a bucket's largest
   component meet all others in blocks of bounded size, are refused by size, by the distances to the hub (Jaccard
   distance is a metric) and by sketch, or else compared on full sets.  Members of the largest component never meet
   each other.  A block returns a spanning forest of its links, never its pairs.
6. Components of all links give each document the smallest doc_id that it reaches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .components import components
from .shared import Marks, Scratch, has_hashes, only, packed, utf8

_U = np.uint64
BANDS, ROWS = 32, 5
SKETCH_BITS = 256
#: Sketches refuse a pair only if they put its similarity this far below the threshold: five standard errors, as 4,000
#: pairs of similarity 0.85 differ in at most 66 bits (standard deviation 7.1), and 76 are refused.
MARGIN = 0.2
#: Shingles that one side of a block holds, about; a single larger set is a side of its own.
BLOCK_SHINGLES = 100_000
#: A class with more than this share of all rows is joined apart, by broadcast: there are fewer such classes than this.
HOT_CLASSES = 1024


@dataclass(frozen=True)
class Rule:
    """Sets of shingles of so many words are linked if 100 * intersection >= percent * union."""

    words: int = 5
    percent: int = 80
    bands: int = BANDS
    rows: int = ROWS

    @property
    def samples(self) -> int:
        return self.bands * self.rows

    def linked(self, common, size_a, size_b):
        return 100 * common >= self.percent * (size_a + size_b - common)

    def refused_from(self) -> int:
        """The XOR count of sketches from which a pair is refused."""
        least = max(0.0, self.percent / 100 - MARGIN)
        differing = 2 * self.samples * (1 - least)
        return int(np.ceil(SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** differing))) + 1


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of lower-cased texts and the text of each; a text of fewer words is one shingle."""
    buf = tv.lower_ascii(buf)
    runs = tv.Runs(buf, offsets, tv.SPACED)
    hashes = tv.span_hashes(buf, runs.starts, runs.ends)
    at, text = tv.window_starts(runs.first, runs.count, words)
    keys = tv.window_hashes(hashes, words)[at]
    for n in range(1, words):
        short = np.flatnonzero(runs.count == n)
        if len(short):
            keys = np.concatenate((keys, tv.window_hashes(hashes, n)[runs.first[short]] ^ _U(n)))
            text = np.concatenate((text, short))
    return tv.distinct(keys, text)


def _seeds(n: int) -> np.ndarray:
    return tv.splitmix(np.arange(1000, 1000 + n, dtype=_U)) | _U(1)


def min_samples(keys: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """n MinHash samples per set; set i is keys[first[i]:first[i + 1]], none is empty."""
    out = np.empty((len(first) - 1, n), np.uint32)
    product = np.empty_like(keys)
    for k, seed in enumerate(_seeds(n)):
        np.multiply(keys, seed, out=product)
        out[:, k] = np.minimum.reduceat(product, first[:-1]) >> _U(32)
    return out


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps: every (sample number, value) flips one of SKETCH_BITS bits."""
    n = samples.shape[1]
    at = (tv.splitmix(samples.astype(_U) + (np.arange(1, n + 1, dtype=_U) << _U(32))) % _U(SKETCH_BITS)).astype(np.int64)
    flips = np.zeros((len(samples), SKETCH_BITS), np.uint8)
    np.add.at(flips, (np.arange(len(samples))[:, None], at), 1)
    return np.packbits(flips & 1, axis=1, bitorder="little")


def band_keys(samples: np.ndarray, bands: int) -> np.ndarray:
    rows = samples.astype(_U).reshape(len(samples), bands, -1)
    key = np.broadcast_to(_seeds(bands), rows.shape[:2]).copy()
    for k in range(rows.shape[2]):
        key = tv.splitmix(key ^ rows[:, :, k])
    return key.view(np.int64)


SKETCH = tuple(f"s{k}" for k in range(SKETCH_BITS // 64))
FEATURES = "doc_id long, text_hash long, digest binary, size long, " + ", ".join(f"{s} long" for s in SKETCH) + ", bands array<long>"


def _digest(keys: bytes) -> bytes:
    return hashlib.blake2b(keys, digest_size=16).digest()


def _features(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    for batch, buf, offsets in tv.steps(batches, "text", 1 << 19):
        keys, text = shingle_sets(buf, offsets, rule.words)
        cut = np.searchsorted(text, np.arange(batch.num_rows + 1))
        sizes = np.diff(cut)
        full = np.flatnonzero(sizes)
        digests: list[bytes | None] = [None] * batch.num_rows
        sketches = np.zeros((batch.num_rows, len(SKETCH)), np.int64)
        bands: list[np.ndarray | None] = [None] * batch.num_rows
        if len(full):
            samples = min_samples(keys, np.append(cut[full], cut[-1]), rule.samples)
            sketches[full] = odd_sketches(samples).view(np.int64)
            for i, b in zip(full.tolist(), band_keys(samples, rule.bands), strict=True):
                digests[i], bands[i] = _digest(keys[cut[i] : cut[i + 1]].tobytes()), b
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), *(pa.array(sketches[:, k]) for k in range(len(SKETCH))), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "text_hash", "digest", "size", *SKETCH, "bands"])


def _sets(batches: Iterator[pa.RecordBatch], rule: Rule, wanted) -> Iterator[pa.RecordBatch]:
    """Shingle sets, named by their digests, of the texts whose slots the bitmap has.

    The bitmap is looked up here: a stage with two steps in Python would have twice as many workers in memory.
    """
    marked = (b.filter(pa.array(has_hashes(wanted.value, b.column("slot").to_numpy()))) for b in batches)
    for batch, buf, offsets in tv.steps(marked, "text"):
        keys, text = shingle_sets(buf, offsets, rule.words)
        cut = np.searchsorted(text, np.arange(batch.num_rows + 1))
        sets = [keys[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([_digest(x) for x in sets], pa.binary()), pa.array(sets, pa.binary())], names=["digest", "keys"])


def _sets_of(source: DataFrame, classes: DataFrame, wanted: DataFrame, rule: Rule, scratch: Scratch, name: str) -> DataFrame:
    """The shingle sets (node, keys) of the classes whose nodes are wanted; other texts are neither shuffled nor hashed again."""
    wanted = scratch.keep(classes.select("node", "rep", "digest").join(wanted.hint("merge"), "node", "left_semi"), f"{name}-wanted")
    marks = Marks(wanted, "rep")
    bitmap = marks.shared
    found = source.select("text", marks.slot("doc_id").alias("slot")).mapInArrow(lambda b: _sets(b, rule, bitmap), "digest binary, keys binary")
    # each wanted digest is one node's, and the join has dealt the sets by it
    found = scratch.keep(found.join(wanted.select("digest", "node").hint("merge"), "digest").dropDuplicates(["digest"]).select("node", "keys"), name)
    scratch.drop(f"{name}-wanted")
    return found


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def _with_hub(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """The similarity of members with their hubs."""
    for whole in batches:
        for at in range(0, whole.num_rows, 500):
            batch = whole.slice(at, 500)
            mine, hubs = batch.column("keys").to_pylist(), batch.column("hub_keys").to_pylist()
            common = [_common(np.frombuffer(x, _U), np.frombuffer(y, _U)) for x, y in zip(mine, hubs, strict=True)]
            size = [len(x) + len(y) >> 3 for x, y in zip(mine, hubs, strict=True)]
            away = [1 - c / max(1, n - c) for c, n in zip(common, size, strict=True)]
            linked = [100 * c >= rule.percent * (n - c) for c, n in zip(common, size, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("hub"), pa.array(away, pa.float64()), pa.array(linked, pa.bool_())], names=["node", "hub", "away", "linked"])


class _Block:
    """Rows of a block: `left` ones, which are outside of their bucket's largest component, meet those that are not."""

    def __init__(self, rows: pd.DataFrame, rule: Rule):
        self.rule, self.node, self.group = rule, rows["node"].to_numpy(), rows["root"].to_numpy().copy()
        self.left, self.minor, self.size = rows["left"].to_numpy(bool), rows["minor"].to_numpy(bool), rows["size"].to_numpy()
        self.away, self.sketch = rows["away"].to_numpy(float), rows[list(SKETCH)].to_numpy(np.int64)

    def near(self, i: int) -> np.ndarray:
        """Members that the left member i may be linked with; two outside members meet once."""
        rule, size, away = self.rule, self.size, self.away
        near = ~self.left & (self.group != self.group[i]) & ~(np.abs(away - away[i]) > 1 - rule.percent / 100 + 1e-9) & (100 * np.minimum(size, size[i]) >= rule.percent * np.maximum(size, size[i]))
        near = np.flatnonzero(near & (~self.minor | (self.node > self.node[i])))
        return near[np.bitwise_count(self.sketch[near] ^ self.sketch[i]).sum(1) < rule.refused_from()]


def _hopeful(rows: pd.DataFrame, rule: Rule) -> pd.DataFrame:
    """Members of a block that sizes, distances to the hub and sketches leave a partner in another component."""
    block, some = _Block(rows, rule), np.zeros(len(rows), bool)
    for i in np.flatnonzero(block.left):
        near = block.near(i)
        some[near] = True
        some[i] = len(near) > 0
    return rows[some]


def _linked(rows: pd.DataFrame, rule: Rule) -> pd.DataFrame:
    """A spanning forest of the links of a block that join different components."""
    block, keys = _Block(rows, rule), [np.frombuffer(x, _U) for x in rows["keys"]]
    roots = block.group.copy()
    root = dict(zip(roots, roots, strict=True))

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    found = []
    for i in np.flatnonzero(block.left):
        for j in block.near(i).tolist():
            a, b = find(roots[i]), find(roots[j])
            if a != b and rule.linked(_common(keys[i], keys[j]), block.size[i], block.size[j]):
                root[max(a, b)] = min(a, b)
                found.append((block.node[i], block.node[j]))
                block.group[block.group == max(a, b)] = min(a, b)
    return pd.DataFrame(found, columns=["a", "b"])


def _classes(features: DataFrame, scratch: Scratch) -> tuple[DataFrame, bool]:
    """A row per distinct set: digest, node, rep (its smallest doc_id), copies, size, sketch and bands; and whether nodes differ from reps.

    A node is the rep; only where rows of one doc_id hold different sets, classes share a rep, and all but one of them
    get a number of their own above all doc_ids.
    """
    usable = features.where("doc_id is not null and size > 0")
    classes = usable.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), *(F.first(c).alias(c) for c in ("size", *SKETCH, "bands")))
    classes = scratch.keep(classes, "classes")
    shared = classes.groupBy("rep").agg(F.count("*").alias("n"), F.min("digest").alias("least")).where("n > 1").select("rep", "least")
    if not shared.limit(1).count():
        return classes.withColumn("node", F.col("rep")), False
    free = F.lit(classes.agg(F.max("rep")).first()[0] + 1)
    node = F.when(F.col("least").isNull() | (F.col("digest") == F.col("least")), F.col("rep")).otherwise(free + F.monotonically_increasing_id())
    return scratch.keep(classes.join(shared.hint("merge"), "rep", "left").withColumn("node", node).drop("least"), "nodes"), True


def near_duplicates(docs: DataFrame, rule: Rule, scratch: Scratch) -> DataFrame:
    """Per row: doc_id, text_hash, n_shingles, component_id (the smallest doc_id that it reaches) and kept.

    kept: it is the document that component_id names.  Null and empty texts and those without words have no shingles and
    are linked with nothing.  Rows that repeat a doc_id with the same set are one document and have the same verdict;
    with other sets they are documents of their own, told apart by text_hash, of which one may be kept and the other not.
    A null doc_id is linked with nothing and kept.  Other columns are not read.  An empty table gives no rows.
    """
    source = only(docs, doc_id=F.col("doc_id").cast("long"), text_hash=F.xxhash64(F.col("text").cast("string")), text=utf8("text"))
    features = scratch.keep(source.mapInArrow(lambda b: _features(b, rule), FEATURES), "features")
    classes, shared = _classes(features, scratch)
    sketches = classes.select("node", *SKETCH)
    member = classes.select(F.explode("bands").alias("key"), "node")
    # buckets with the same members are one
    buckets = member.groupBy("key").agg(F.count("*").alias("members"), F.min("node").alias("least"), F.expr("bit_xor(xxhash64(node))").alias("same")).where("members > 1")
    buckets = buckets.groupBy("members", "least", "same").agg(F.min("key").alias("key")).select("key", "members")
    meets = scratch.keep(member.join(buckets.hint("merge"), "key").join(classes.select("node", "size", "copies"), "node"), "meets")
    # the hub is the class with most copies
    hubs = meets.groupBy("key").agg(F.max(F.struct("copies", F.negative("node").alias("order"))).alias("top"), F.sum("size").alias("shingles"))
    hubs = scratch.keep(hubs.select("key", F.negative("top.order").alias("hub"), "shingles"), "hubs")
    meets = scratch.keep(meets.drop("copies").join(hubs, "key"), "members")

    theirs = sketches.select(F.col("node").alias("hub"), *(F.col(c).alias(f"hub_{c}") for c in SKETCH))
    differ = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"hub_{c}"))) for c in SKETCH), F.lit(0))
    pairs = meets.where("node <> hub").select("node", "hub").distinct().join(sketches, "node").join(theirs, "hub").where(differ < rule.refused_from()).select("node", "hub")
    pairs = scratch.keep(pairs, "pairs")
    sets = _sets_of(source, classes, pairs.select(F.explode(F.array("node", "hub")).alias("node")).distinct(), rule, scratch, "sets")
    compared = pairs.join(sets, "node").join(sets.select(F.col("node").alias("hub"), F.col("keys").alias("hub_keys")), "hub")
    compared = scratch.keep(compared.mapInArrow(lambda b: _with_hub(b, rule), "node long, hub long, away double, linked boolean"), "compared")
    first = scratch.keep(components(compared.where("linked").select(F.col("node").alias("a"), F.col("hub").alias("b")), scratch, "first"), "roots")

    # buckets that hold several components yet: who is outside of the largest one
    placed = meets.where("members > 2").join(first, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = scratch.keep(placed, "placed")
    largest = placed.groupBy("key", "root").agg(F.count("*").alias("n"), F.sum("size").alias("held")).groupBy("key").agg(F.max(F.struct("n", "root", "held")).alias("top"), F.count("*").alias("parts")).where("parts > 1")
    largest = scratch.keep(largest.select("key", F.col("top.root").alias("largest"), F.col("top.held").alias("held")), "largest")
    # without a distance to the hub, where sketches refused the pair, that test is left out
    known = compared.select("node", "hub", "away")
    rest = placed.join(largest, "key").join(known, ["node", "hub"], "left").withColumn("away", F.when(F.col("node") == F.col("hub"), F.lit(0.0)).otherwise(F.col("away")))
    # a block holds a side of the outside members, and a side of all; outside members stand in it as either
    sides = lambda held: F.greatest(F.lit(1), F.least(F.ceil(held / BLOCK_SHINGLES).cast("int"), F.col("members").cast("int")))
    rest = rest.withColumn("minor", F.col("root") != F.col("largest")).withColumn("outside", sides(F.col("shingles") - F.col("held"))).withColumn("all", sides(F.col("shingles")))
    side = lambda n, seed: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(n)).cast("int")
    rest = rest.join(sketches, "node").withColumn("i", side("outside", 1)).withColumn("j", side("all", 2))
    place = lambda i, j, left: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(left).alias("left"))
    as_left = F.transform(F.when(F.col("minor"), F.sequence(F.lit(0), F.col("all") - 1)).otherwise(F.array().cast("array<int>")), lambda j: place(F.col("i"), j, True))
    as_right = F.transform(F.sequence(F.lit(0), F.col("outside") - 1), lambda i: place(i, F.col("j"), False))
    rest = rest.withColumn("place", F.explode(F.concat(as_left, as_right))).select("key", "place.*", "minor", "node", "size", "away", "root", *SKETCH)
    hopeful = scratch.keep(rest.groupBy("key", "i", "j").applyInPandas(lambda rows: _hopeful(rows, rule), rest.schema), "hopeful")
    sets = _sets_of(source, classes, hopeful.select("node").distinct(), rule, scratch, "more-sets")
    more = hopeful.join(sets, "node").groupBy("key", "i", "j").applyInPandas(lambda rows: _linked(rows, rule), "a long, b long")
    more = scratch.keep(more, "more")
    links = first.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more)
    roots = scratch.keep(components(links, scratch, "last"), "components")

    named = _names(classes, roots, scratch, shared)
    for name in ("meets", "hubs", "members", "pairs", "sets", "compared", "placed", "largest", "hopeful", "more-sets", "more"):
        scratch.drop(name)
    return _verdicts(features, named)


def _names(classes: DataFrame, roots: DataFrame, scratch: Scratch, shared: bool) -> DataFrame:
    """digest, copies, component_id and keeps (its smallest doc_id is the component's) of classes with copies or links, or which share a doc_id."""
    placed = classes.select("digest", "copies", "node", "rep").join(roots, "node", "left").where("copies > 1 or root is not null" + " or true" * shared)
    if not shared:
        return scratch.keep(placed.select("digest", "copies", F.coalesce("root", "node").alias("component_id"), F.coalesce(F.col("root") == F.col("node"), F.lit(True)).alias("keeps")), "named")
    placed = scratch.keep(placed.withColumn("root", F.coalesce("root", "node")), "placed-classes")
    least = placed.groupBy("root").agg(F.min(F.struct("rep", "node")).alias("least"))
    return scratch.keep(placed.join(least, "root").select("digest", "copies", F.col("least.rep").alias("component_id"), (F.col("least.node") == F.col("node")).alias("keeps")), "named")


def _verdicts(features: DataFrame, named: DataFrame) -> DataFrame:
    """Rows with the names of their classes; rows without a set, and classes with very many copies, stay out of the shuffle."""
    rows = features.select("doc_id", "text_hash", "digest", F.col("size").alias("n_shingles"))
    # fewer than HOT_CLASSES rows by this condition
    hot = named.where(F.col("copies") > features.count() // HOT_CLASSES + 1)
    plain = F.col("digest").isNull() | F.col("doc_id").isNull()
    alone = rows.where(plain).withColumn("component_id", F.col("doc_id")).withColumn("keeps", F.lit(True))
    many = rows.where(~plain).join(F.broadcast(hot.drop("copies")), "digest")
    few = rows.where(~plain).join(F.broadcast(hot.select("digest")), "digest", "left_anti").join(named.join(F.broadcast(hot.select("digest")), "digest", "left_anti").drop("copies"), "digest", "left")
    out = alone.unionByName(many).unionByName(few)
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"), (F.coalesce("keeps", F.lit(True)) & F.coalesce(F.col("doc_id") == component, F.lit(True))).alias("kept"))


def keep_firsts(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The documents that near_duplicates keeps, with all their columns; found is its result over them as a written table.

    One row of each document stays: of rows with one doc_id and equal sets the one with the smallest hash of its text.
    Rows whose doc_id is null all stay.  Only rows of which some may go are shuffled.
    """
    found = found.where("doc_id is not null")
    kept = found.where("kept").groupBy("doc_id", "component_id", "n_shingles").agg(F.min("text_hash").alias("stays"), F.count("*").alias("n"))
    several = kept.where("n > 1").select("doc_id", "component_id", "n_shingles", "stays")
    others = found.where("kept").join(several.hint("merge"), ["doc_id", "component_id", "n_shingles"]).where("text_hash <> stays")
    gone = found.where("not kept").select("doc_id", "text_hash").unionByName(others.select("doc_id", "text_hash")).distinct()
    touched = Marks(gone.select("doc_id").unionByName(several.select("doc_id")), "doc_id")
    rows = packed(docs, doc_id=F.col("doc_id").cast("long"), text_hash=F.xxhash64(F.col("text").cast("string"))).withColumn("touched", touched.has("doc_id") & F.col("doc_id").isNotNull())
    left = rows.where("touched").join(gone.hint("merge"), ["doc_id", "text_hash"], "left_anti").dropDuplicates(["doc_id", "text_hash"])
    return rows.where("not touched").select("row.*").unionByName(left.select("row.*"))
