"""MinHash near-dedup by a multi-index Hamming join.

A text is its words (A-Z lowered, parted by ASCII white space); its set, the distinct shingles of
a ``Rule``'s number of words (all words as one, if fewer). Two texts are linked when 100 times the
intersection of their sets is at least the rule's percentage of the union: ``STRICT`` has three
words and 85, ``USUAL`` five words and 80. Texts with the same words are one *node*; copies are
never compared.

A node's signature has 32 minima, 16 bits of each; the distance of two signatures is the number of
minima that differ. The 32 are split into eight chunks of four. By the pigeonhole principle two
signatures at a distance of 15 or less differ in one minimum at most in some chunk; so each node
is entered under every three of a chunk's four minima (32 keys), and all such pairs share a key.
At a similarity of 0.85 the distance is 4.8 on average, and passes the radius (14) for 19 pairs in
a million. At 0.8 it is 6.4 and passes 18 for 1 in a million; of pairs at 16 to 18, for which the
pigeonhole is no help, few share no key: 1 in a million of all pairs at 0.8. Beside the signature
stands a sketch: hashes fall into 256 bins, and each bin keeps a byte of its least. Two sets'
share of equal bins is close to their similarity, the closer the fewer shingles they have; it is
below the rule's likeness (0.74 for 0.85 and 0.67 for 0.8, five standard deviations down) for less
than one pair in a million, so pairs below it are not fetched for the exact test. Last come
counts: how many shingles fall into each of 256 bins. Two sets share at most the sum of the lesser
counts, so pairs whose bound falls short of the threshold are surely no link; for sets of a few
hundred shingles the bound is nearly the true number, which keeps large groups of texts just under
the threshold from being fetched pair by pair.

Pairs of a key's nodes are never all written out. Three steps find the components:

1. each node against the first node of a key, the one with which it shares most keys;
2. where a key still holds several components, one node of each against one of the largest,
   ``ROUNDS`` times;
3. where it still does, all pairs of nodes from different components whose signatures and sketches
   allow it, in blocks of bounded size. Nodes of the key's largest component meet the others
   only.

Only a link that was confirmed on the full sets joins components, and step 3 leaves out no pair
of different components that shares a key and is within the radius, so that every such link counts.

Null and empty texts, and texts without words, have no shingles and no links. The component is
the least doc_id reachable; rows without doc_id have none to give, and where no row of a
component has one it is null and the rows are kept. Repeated rows are one node.

Sets are compared as 64-bit hashes of their shingles, and nodes are known by such a hash of their
words.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import KEY, doc_id, keyed, map_rows, table, texts
from millrace.session import scratch_path, store

DENOMINATOR = 100
MINIMA, CHUNK = 32, 4
BINS = 256
ROUNDS, TRIES = 3, 4  # of step 2, and per node in each; step 3 leaves nothing out
MAIN_BLOCK, OTHER_BLOCK = 2048, 512
MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Rule:
    """Words of a shingle, least percentage of the union, and what a pair must keep to be tested."""

    shingle: int
    numerator: int
    radius: int
    likeness: float


STRICT = Rule(3, 85, 14, 0.74)
USUAL = Rule(5, 80, 18, 0.67)


def word_hashes(text: str) -> tuple[np.ndarray, bytes]:
    """Hash of each word, and the words in their plain form."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()
    known = {w: xxhash.xxh64_intdigest(w) for w in set(words)}
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words)), b" ".join(words)


def shingle_set(text: str, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles; empty if there are no words."""
    words, _ = word_hashes(text)
    return shingles(words, size)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    size = min(size, len(words))
    if not size:
        return words
    last = len(words) - size + 1
    h = np.full(last, size, np.uint64)
    for k in range(size):
        h = (h ^ words[k : k + last]) * MIX
        h ^= h >> np.uint64(32)
    return np.unique(h)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The low 16 bits of the least value of each of ``MINIMA`` mixings of the hashes."""
    a = (np.arange(1, MINIMA + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
    out = np.empty(MINIMA, "<u2")
    for k in range(MINIMA):
        x = (hashes ^ (a[k] >> np.uint64(7))) * a[k]
        out[k] = ((x ^ (x >> np.uint64(31))) * MIX >> np.uint64(20)).min() & np.uint64(0xFFFF)
    return out


def sketch(hashes: np.ndarray) -> np.ndarray:
    """One byte per bin of sorted distinct hashes: of the least in the bin, 0 if it is empty."""
    out = np.zeros(BINS, np.uint8)
    bins = (hashes >> np.uint64(56)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
    out[bins[first]] = 1 + (hashes[first] >> np.uint64(40)) % np.uint64(255)
    return out


def bin_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes fall into each bin, at most 255."""
    return np.minimum(np.bincount((hashes >> np.uint64(48)).astype(np.int64) % BINS, minlength=BINS), 255).astype(np.uint8)


def may_link(left: np.ndarray, right: np.ndarray, n: np.ndarray, m: np.ndarray, rule: Rule = STRICT) -> np.ndarray:
    """Which pairs of rows their counts allow to be linked; ``n`` and ``m`` are the sizes of the sets.

    Where both counts of a bin were cut at 255, both sets lack shingles; the fewer count as shared."""
    a, b = left[:, -BINS:], right[:, -BINS:]
    lacking = np.minimum(n - a.sum(1, dtype=np.int64), m - b.sum(1, dtype=np.int64))
    most = np.minimum(np.minimum(a, b).sum(1, dtype=np.int64) + lacking, np.minimum(n, m))
    return DENOMINATOR * most >= rule.numerator * (n + m - most)


def close(left: np.ndarray, right: np.ndarray, rule: Rule) -> np.ndarray:
    """Which pairs of rows (signature and sketch) are within the radius and alike in their bins."""
    x, y = (np.ascontiguousarray(m[:, : 2 * MINIMA]).view("<u2") for m in (left, right))
    apart = (x != y).sum(1)
    a, b = left[:, 2 * MINIMA : -BINS], right[:, 2 * MINIMA : -BINS]
    filled = ((a | b) != 0).sum(1)
    same = ((a == b) & (a != 0)).sum(1)
    return (apart <= rule.radius) & (same >= rule.likeness * filled)


def first_key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Number of the first key (as in ``index_keys``) that the rows of each pair share."""
    x, y = (np.ascontiguousarray(m[:, : 2 * MINIMA]).view("<u2") for m in (left, right))
    equal = (x == y).reshape(len(x), MINIMA // CHUNK, CHUNK)
    chunk = (equal.sum(2) >= CHUNK - 1).argmax(1)
    # The place that differs is the one left out; where none differs, the first.
    return chunk * CHUNK + (~equal[np.arange(len(x)), chunk]).argmax(1)


def marks(hashes: np.ndarray) -> bytes:
    """Signature, sketch and counts of a set, end to end."""
    return signature(hashes).tobytes() + sketch(hashes).tobytes() + bin_counts(hashes).tobytes()


def marks_of(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 2 * MINIMA + 2 * BINS)


def index_keys(signatures: np.ndarray) -> np.ndarray:
    """For each signature the keys of its chunks with each one of their minima left out."""
    parts = signatures.astype(np.uint64).reshape(len(signatures), -1, CHUNK)
    keys = np.empty((len(signatures), parts.shape[1], CHUNK), np.uint64)
    for left_out in range(CHUNK):
        h = np.zeros(parts.shape[:2], np.uint64)
        for k in range(CHUNK):
            if k != left_out:
                h = h << np.uint64(16) | parts[:, :, k]
        number = np.arange(parts.shape[1], dtype=np.uint64) * np.uint64(CHUNK) + np.uint64(left_out)
        # 48 bits of minima and 16 for the chunk and the place: nothing is lost.
        keys[:, :, left_out] = h << np.uint64(16) | number
    return keys.reshape(len(signatures), -1).view(np.int64)


def describe(docs: DataFrame, rule: Rule) -> DataFrame:
    """_id, _hash, node, n (size of the set), sig of each row; node is null where there is no word."""

    def run(columns: list[list]) -> list:
        import xxhash

        out: list[list] = [columns[0], columns[1], [], [], []]
        for text in columns[2]:
            words, plain = word_hashes(text)
            found = shingles(words, rule.shingle)
            out[2].append(xxhash.xxh64_intdigest(plain) - 2**63 if len(found) else None)
            out[3].append(len(found))
            out[4].append(marks(found) if len(found) else None)
        return out

    return map_rows(keyed(texts(docs)).select(*KEY, "text"), "_id long, _hash long, node long, n long, sig binary", run)


def with_keys(nodes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = index_keys(marks_of(batch.column(1))[:, : 2 * MINIMA].copy().view("<u2"))
            node = np.repeat(batch.column(0).to_numpy(), keys.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(node)], names=["key", "node"])

    return nodes.select("node", "sig").mapInArrow(run, "key long, node long")


def sizes_allow(n: str, m: str, rule: Rule):
    return rule.numerator * F.greatest(n, m) <= DENOMINATOR * F.least(n, m)


def near(pairs: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) that their sizes and signatures allow to be linked."""
    a = nodes.select(F.col("node").alias("a"), F.col("n").alias("_na"), F.col("sig").alias("_sa"))
    b = nodes.select(F.col("node").alias("b"), F.col("n").alias("_nb"), F.col("sig").alias("_sb"))
    both = pairs.join(a, "a").join(b, "b").where(sizes_allow("_na", "_nb", rule)).select("a", "b", "_sa", "_sb", "_na", "_nb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = marks_of(batch.column(2)), marks_of(batch.column(3))
            good = close(x, y, rule) & may_link(x, y, batch.column(4).to_numpy(), batch.column(5).to_numpy(), rule)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return both.mapInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, plain: DataFrame, rule: Rule) -> DataFrame:
    """The pairs that are linked on their full sets. ``plain`` is bucketed by node, so that texts
    move once: those of ``b``, which many pairs may share, are fetched apart and joined last,
    where a shuffle on both sides lets a common one be split."""
    hub = pairs.select(F.col("b").alias("node")).distinct().join(plain, "node").select(F.col("node").alias("b"), F.col("text").alias("_tb"))
    both = pairs.join(plain.select(F.col("node").alias("a"), F.col("text").alias("_ta")), "a").join(hub.hint("merge"), "b")

    def run(columns: list[list]) -> list:
        hub_text, hub_set = None, None
        good = []
        for a, b, ta, tb in zip(*columns):
            if tb != hub_text:
                hub_text, hub_set = tb, shingle_set(tb, rule.shingle)
            other = shingle_set(ta, rule.shingle)
            common = len(np.intersect1d(hub_set, other, assume_unique=True))
            if DENOMINATOR * common >= rule.numerator * (len(hub_set) + len(other) - common):
                good.append((a, b))
        return [list(c) for c in zip(*good)] if good else [[], []]

    return map_rows(both.select("a", "b", "_ta", "_tb"), "a long, b long", run)


def merge_components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, comp) after the links (a, b); nodes that are not listed are their own.

    In each round every component hooks on to the least one that it is linked with, until no
    link leads out: rounds grow with the logarithm of the longest chain."""
    ends_of = links.select(F.col("a").alias("node")).unionAll(links.select(F.col("b").alias("node"))).distinct()
    fresh = ends_of.join(labels, "node", "left_anti").select("node", F.col("node").alias("comp"))
    labels = store(labels.unionAll(fresh), "labels")
    ends = renamed(links, labels.select("node", "comp"))
    while not ends.isEmpty():
        both = ends.unionAll(ends.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy(F.col("a").alias("comp")).agg(F.min("b").alias("_p"))
        parent = parent.select("comp", F.least("comp", "_p").alias("_p"))
        up = parent.select(F.col("comp").alias("_p"), F.col("_p").alias("_pp"))
        parent = store(parent.join(up, "_p", "left").select("comp", F.coalesce("_pp", "_p").alias("_p")), "parents")
        labels = store(labels.join(parent, "comp", "left").select("node", F.coalesce("_p", "comp").alias("comp")), "labels")
        ends = renamed(ends, parent)
    return labels


def renamed(ends: DataFrame, names: DataFrame) -> DataFrame:
    """The pairs after renaming both sides; those that became equal are gone."""
    old, new = names.columns
    left = names.select(F.col(old).alias("a"), F.col(new).alias("_a"))
    right = names.select(F.col(old).alias("b"), F.col(new).alias("_b"))
    joined = ends.join(left, "a").join(right, "b").where("_a != _b")
    return store(joined.select(F.col("_a").alias("a"), F.col("_b").alias("b")).distinct(), "links")


def link_texts(docs: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """The description of each row, and (node, comp) of the nodes that are linked with others."""
    spark = docs.sparkSession
    rows = store(describe(docs, rule), "rows")
    nodes = store(rows.where("node is not null").groupBy("node").agg(F.first("n").alias("n"), F.first("sig").alias("sig")), "nodes")
    keys = with_keys(nodes)
    hubs = keys.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    shared = store(keys.join(hubs, "key"), "keys")
    name = plain_texts(docs, shared.select("node").distinct())
    plain = spark.table(name)

    labels = spark.createDataFrame([], "node long, comp long")
    best = shared.where("node != hub").groupBy("node", "hub").agg(F.count("*").alias("_n"))
    best = best.groupBy(F.col("node").alias("a")).agg(F.max_by("hub", F.struct("_n", "hub")).alias("b"))
    tried = store(near(best, nodes, rule), "pairs")
    labels = merge_components(labels, store(confirmed(tried, plain, rule), "links"))

    def by_component() -> DataFrame:
        return shared.select("key", "node").join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))

    done = [tried]
    for turn in range(ROUNDS):
        # Of each component of a key one node, another in each key and turn; the largest one's is the hub.
        some = F.struct(F.xxhash64("node", "key", F.lit(turn)).alias("h"), "node")
        reps = by_component().groupBy("key", "comp").agg(F.min(some).alias("rep"), F.count("*").alias("_n"))
        reps = store(reps.select("key", "_n", F.col("rep.node").alias("node")), "reps")
        first = reps.groupBy("key").agg(F.max(F.struct("_n", "node")).alias("hub"), F.count("*").alias("_comps"))
        # A node takes part in as many keys as there are; it tries the hubs of its rarest keys.
        first = first.where("_comps > 1").select("key", F.col("hub.node").alias("hub"), "_comps")
        tries = reps.join(first, "key").where("node != hub")
        rare = Window.partitionBy("node").orderBy("_comps", "hub")
        tries = tries.groupBy("node", "hub").agg(F.min("_comps").alias("_comps")).withColumn("_turn", F.row_number().over(rare))
        pairs = tries.where(F.col("_turn") <= TRIES).select(F.col("node").alias("a"), F.col("hub").alias("b"))
        done.append(store(near(new_pairs(pairs, done), nodes, rule), "pairs"))
        labels = merge_components(labels, store(confirmed(done[-1], plain, rule), "links"))

    rest = new_pairs(cross_pairs(by_component(), nodes, rule), done)
    labels = merge_components(labels, store(confirmed(store(rest, "pairs"), plain, rule), "links"))
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return rows, labels


def new_pairs(pairs: DataFrame, tried: list[DataFrame]) -> DataFrame:
    """Distinct pairs, whichever way round, that were not tried before."""
    pairs = pairs.select(F.least("a", "b").alias("_x"), F.greatest("a", "b").alias("_y")).distinct()
    for t in tried:
        pairs = pairs.join(t.select(F.least("a", "b").alias("_x"), F.greatest("a", "b").alias("_y")), ["_x", "_y"], "left_anti")
    return pairs.select(F.col("_x").alias("a"), F.col("_y").alias("b"))


def plain_texts(docs: DataFrame, needed: DataFrame) -> str:
    """A table of one text per needed node, bucketed by node; returns its name."""
    spark = docs.sparkSession

    def run(columns: list[list]) -> list:
        import xxhash

        plain = [b" ".join(t.encode("utf-8", "surrogatepass").lower().split()) for t in columns[0]]
        return [[xxhash.xxh64_intdigest(p) - 2**63 for p in plain], [p.decode("utf-8", "surrogatepass") for p in plain]]

    found = map_rows(texts(docs).select("text"), "node long, text string", run)
    found = found.join(needed, "node", "left_semi").dropDuplicates(["node"])
    name = f"near_dedup_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = found.write.bucketBy(parts, "node").sortBy("node").option("path", scratch_path(spark, "texts"))
    writer.format("parquet").saveAsTable(name)
    return name


def cross_pairs(by_component: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of nodes that share a key, are in different components and are within the radius.

    A block of a key's main component meets each block of its other nodes, and those blocks meet
    each other and themselves; each meeting is a group of bounded size."""
    sizes = by_component.groupBy("key", "comp").agg(F.count("*").alias("_n"))
    whole = sizes.groupBy("key").agg(
        F.sum("_n").alias("_all"), F.max(F.struct("_n", "comp")).alias("_main"), F.count("*").alias("_comps")
    )
    plan = whole.where("_comps > 1").select(
        "key",
        F.col("_main.comp").alias("_main"),
        F.ceil(F.col("_main._n") / MAIN_BLOCK).alias("_mains"),
        F.ceil((F.col("_all") - F.col("_main._n")) / OTHER_BLOCK).alias("_others"),
    )
    rows = by_component.join(plan, "key").join(nodes.select("node", "n", "sig"), "node")
    main = F.col("comp") == F.col("_main")
    blocks = F.when(main, F.col("_mains")).otherwise(F.col("_others"))
    rows = rows.withColumn("_block", F.pmod(F.xxhash64("node"), blocks))
    mains, others = (F.sequence(F.lit(0).cast("long"), F.col(c) - 1) for c in ("_mains", "_others"))

    def meeting(kind: str, x, y):
        return F.struct(F.lit(kind).alias("kind"), x.alias("x"), y.alias("y"))

    block = F.col("_block")
    of_main = F.transform(others, lambda o: meeting("main", block, o))
    of_other = F.concat(
        F.transform(mains, lambda m: meeting("main", m, block)),
        F.transform(others, lambda o: meeting("other", F.least(o, block), F.greatest(o, block))),
    )
    placed = rows.withColumn("_at", F.explode(F.when(main, of_main).otherwise(of_other)))
    number = F.col("key").bitwiseAND(0xFFFF).alias("number")
    placed = placed.select(F.xxhash64("key", "_at").alias("_group"), "node", "comp", "n", "sig", number)
    parts = int(by_component.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = placed.repartition(parts, "_group").sortWithinPartitions("_group")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            part = part if held is None else pa.concat_tables([held, part])
            group = part.column(0).to_numpy()
            # The last group may go on in the next batch.
            ended = int(np.searchsorted(group, group[-1]))
            held = part.slice(ended)
            if ended:
                yield within(part.slice(0, ended))
        if held is not None:
            yield within(held)

    def within(part: pa.Table) -> pa.RecordBatch:
        """All pairs of each group, by how far apart they stand in it; a pair that shares several
        keys comes from the first of them."""
        group, node, comp, n = (part.column(k).to_numpy() for k in range(4))
        number = part.column(5).to_numpy()
        sig = marks_of(part.column(4))
        left, right = [node[:0]], [node[:0]]
        apart, rows = 1, np.arange(len(group) - 1)
        while len(rows := rows[group[rows] == group[rows + apart]]):
            other = rows + apart
            least, most = np.minimum(n[rows], n[other]), np.maximum(n[rows], n[other])
            maybe = (comp[rows] != comp[other]) & (rule.numerator * most <= DENOMINATOR * least)
            i, j = rows[maybe], other[maybe]
            for some in range(0, len(i), 1 << 15):
                x, y = i[some : some + (1 << 15)], j[some : some + (1 << 15)]
                good = close(sig[x], sig[y], rule)
                x, y = x[good], y[good]
                good = may_link(sig[x], sig[y], n[x], n[y], rule)
                x, y = x[good], y[good]
                good = first_key(sig[x], sig[y]) == number[x]
                left.append(node[x[good]])
                right.append(node[y[good]])
            apart += 1
            rows = rows[rows + apart < len(group)]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def components(docs: DataFrame, rule: Rule) -> DataFrame:
    """_id, _hash, n, node and component (_comp; null where there is no word) of each row."""
    rows, labels = link_texts(docs, rule)
    return rows.join(labels, "node", "left").withColumn("_comp", F.coalesce("comp", "node")).drop("comp", "sig")


def near_dedup(docs: DataFrame, rule: Rule = STRICT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept; one row per row of ``docs``."""
    rows = components(docs, rule).withColumn("doc_id", doc_id())
    # Where there is no word there is no component: such rows are not joined with each other.
    least = rows.where("node is not null").groupBy("_comp").agg(F.min("doc_id").alias("component_id"))
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.join(least, "_comp", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def keep_one(docs: DataFrame, rule: Rule = STRICT) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row with the least
    doc_id stays (rows without one last, then by the hash of the text), once; so do the rows
    without words, one of each doc_id."""
    rows = components(docs, rule)
    order = F.struct((F.col("_id") == -(2**63)).alias("none"), *KEY)
    first = rows.where("node is not null").groupBy("_comp").agg(F.min(order).alias("first"))
    stay = first.select("first._id", "first._hash").unionAll(rows.where("node is null").select(*KEY).distinct())
    whole = keyed(docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row")))
    return whole.join(stay, list(KEY), "left_semi").dropDuplicates(list(KEY)).select("_row.*")


def query(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup(table(spark, folder, "documents"), STRICT)


def sql() -> str:
    """The same components in DuckDB, from all pairs of texts that share a shingle."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
        ),
        shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(len(w) - 2), lambda i: array_to_string(w[i + 1 : i + 3], ' ')) END) AS s
            FROM words
        ),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
        shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles AS a JOIN shingles AS b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL),
        links AS (
            SELECT a, b FROM shared JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
        ),
        edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reached(doc_id, other) AS (
            SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM reached AS r JOIN edges AS e ON r.other = e.a
        )
        SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
        FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id, n
    """
