"""N-gram Jaccard join by groups of documents with identical prefixes.

Two documents link when their shingle sets have a Jaccard similarity of 3/4 or more. Shingles are
ordered, rare ones first; two sets can only link if they share one within their prefixes, the first
``n - ceil(3n/4) + 1``. Documents of equal prefix and size are one group, which stands in the index
once; what groups share gives candidate groups, and their members are expanded and verified.

What is wanted are the connected components. Copies (equal sets) are one class from the start. Then
classes that share an index entry are compared with one leader each, a few times over, and joined
where they link; what is compared of all the rest are pairs whose components still differ and that
pass the size and position filters, so that no link is lost and a group of near copies of any size
costs few comparisons per member.

Any order of shingles that all documents agree on gives the same links, and the less often a shingle
in a prefix occurs, the fewer documents meet there. Shingles are therefore counted over all documents
where they could come into a prefix, and the most frequent (``FREQUENT`` at most) are ordered behind
the others, by their count; the others go by their hash.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boletim.llm.common import WORD, batches_of, let_workers_import, shuffles_removed, whole_text
from boletim.llm.shingles import mixed, shingle_sets
from boletim.storage import shared_folder

#: Frequent shingles that are ordered behind the others, at most; they go to every task.
FREQUENT = 1 << 18
#: Documents from which a shingle is frequent.
COMMON = 12
#: Prefixes in whose length shingles are counted: what is frequent leaves room for those behind it.
COUNTED = 1.5
#: Words of 64 bits in the bitmap of a set, by which pairs are left out before their sets are read.
BITMAP = 8
#: Times that every class is compared with one leader before the rest is compared pair by pair.
LEADERS = 3
#: Rows that Python is given at a time: a batch of whole sets, or of pairs of them, is held at once.
ROWS = 1000


def _needed(size: int) -> int:
    """Shingles that a set of this size must share with any that it links with."""
    return (3 * size + 3) // 4


def _class_id(found: np.ndarray) -> int:
    """A 64-bit hash of a whole set."""
    total = mixed(found ^ np.uint64(0x9E3779B97F4A7C15)).sum(dtype="uint64")
    return int(mixed(np.array([total + np.uint64(len(found))])).astype("int64")[0])


class Order:
    """Rare shingles by their hash, then frequent ones from the less to the more frequent."""

    def __init__(self, frequent: pd.DataFrame):
        tokens = frequent["token"].to_numpy("int64").view("uint64")
        by_token = np.argsort(tokens)
        self.tokens = tokens[by_token]
        self.rank = np.argsort(np.lexsort((tokens, frequent["n"].to_numpy())))[by_token]

    def prefix(self, found: np.ndarray) -> np.ndarray:
        count = len(found) - _needed(len(found)) + 1
        if not len(self.tokens):
            return found[:count]
        at = np.minimum(np.searchsorted(self.tokens, found), len(self.tokens) - 1)
        common = self.tokens[at] == found
        rare = found[~common][:count]
        if len(rare) == count:
            return rare
        rest = found[common][np.argsort(self.rank[at[common]])]
        return np.concatenate([rare, rest[: count - len(rare)]])


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    whole = whole_text(text)
    return docs.select(
        F.col(key).alias("doc"), whole.alias("text"), F.xxhash64(whole).alias("text_hash")
    )


def _frequent(texts: DataFrame) -> pd.DataFrame:
    """Shingles that many documents hold at places where they could come into a prefix, with how many.

    Copies within a batch count once. The rows that come to the driver are ``FREQUENT`` at most.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held = {found.tobytes(): found for found in shingle_sets(list(batch["text"])) if len(found)}
            near = [f[: int(COUNTED * (len(f) - _needed(len(f)) + 1))] for f in held.values()]
            tokens, n = np.unique(np.concatenate([np.zeros(0, "uint64"), *near]), return_counts=True)
            yield pd.DataFrame({"token": tokens.view("int64"), "n": n.astype("int32")})

    found = texts.select("text").mapInPandas(count, "token bigint, n int")
    total = found.groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= COMMON)
    with shuffles_removed(texts.sparkSession):
        return total.orderBy(F.desc("n"), "token").limit(FREQUENT).toPandas()


def _profiles(texts: DataFrame, order: Order) -> DataFrame:
    """``doc, text_hash, size, class_id, group_id`` of every document; both ids null for an empty
    set."""
    def profile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for found in shingle_sets(list(batch["text"])):
                ids = (_class_id(found), _group_id(order.prefix(found), len(found)))
                rows.append((len(found), *ids) if len(found) else (0, 0, 0))
            out = pd.DataFrame(rows, columns=["size", "class_id", "group_id"], dtype="int64")
            out.insert(0, "doc", batch["doc"].to_numpy())
            out.insert(1, "text_hash", batch["text_hash"].to_numpy())
            yield out

    kind = dict(texts.dtypes)["doc"]
    found = texts.withColumn("doc", F.col("doc").cast("string")).mapInPandas(
        profile, "doc string, text_hash bigint, size bigint, class_id bigint, group_id bigint"
    )
    held = {c: F.when(F.col("size") > 0, F.col(c)) for c in ("class_id", "group_id")}
    return found.withColumns({"doc": F.col("doc").cast(kind), **held})


def _bitmap(found: np.ndarray) -> np.ndarray:
    """Which of ``64 * BITMAP`` bits the tokens of a set fall on."""
    bits = np.zeros(64 * BITMAP, bool)
    bits[mixed(found) % np.uint64(64 * BITMAP)] = True
    return np.packbits(bits, bitorder="little").view("int64")


def _group_id(prefix: np.ndarray, size: int) -> int:
    return _class_id(np.append(prefix, np.uint64(size)))


def _entries(texts: DataFrame, order: Order) -> DataFrame:
    """Index entries ``token, group_id, size, place`` of the groups that a task sees, once each."""
    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for batch in batches:
            tokens, groups, sizes = [], [], []
            for found in shingle_sets(list(batch["text"])):
                prefix = order.prefix(found) if len(found) else found
                group = _group_id(prefix, len(found))
                if len(found) and group not in seen:
                    seen.add(group)
                    tokens.append(prefix)
                    groups.append(group)
                    sizes.append(len(found))
            counts = [len(p) for p in tokens]
            empty = [np.zeros(0, "uint64")]
            yield pd.DataFrame({
                "token": np.concatenate([*tokens, *empty]).view("int64"),
                "group_id": np.repeat(np.array(groups, "int64"), counts),
                "size": np.repeat(np.array(sizes, "int32"), counts),
                "place": np.concatenate([np.arange(c) for c in [*counts, 0]]).astype("int32"),
            })

    return texts.select("text").mapInPandas(
        index, "token bigint, group_id bigint, size int, place int"
    )


def _shared(entries: DataFrame) -> DataFrame:
    """The entries whose token another group has too. Sorted entries pass by, one is held back."""
    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, tied = None, False
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            token, group = rows["token"].to_numpy(), rows["group_id"].to_numpy()
            new = np.ones(len(rows), bool)
            new[1:] = (token[1:] != token[:-1]) | (group[1:] != group[:-1])
            rows = rows[new]
            token = rows["token"].to_numpy()
            same = token[1:] == token[:-1]
            shared = np.zeros(len(rows), bool)
            shared[1:] |= same
            shared[:-1] |= same
            shared[0] |= tied
            held, tied = rows.iloc[-1:], bool(shared[-1])
            yield rows[:-1][shared[:-1]]
        if tied:
            yield held

    dealt = entries.repartition("token").sortWithinPartitions("token", "group_id")
    return dealt.mapInPandas(keep, entries.schema)


class _Store:
    """Tables written once to the shared folder, so that no loop grows the plan behind it.

    What was shuffled for a table is of no use once it is written, so Spark is told to remove such
    files at the end of each write; else they would stay until the driver collects its garbage.
    """

    def __init__(self, spark: SparkSession, folder: str | None):
        self.spark, self.folder = spark, folder or shared_folder(spark, "jaccard")
        self.put_tables: list[str] = []

    def put(self, name: str, table: DataFrame) -> DataFrame:
        with shuffles_removed(self.spark):
            table.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(table.schema).parquet(f"{self.folder}/{name}")

    def put_bucketed(self, name: str, table: DataFrame, key: str, among: DataFrame) -> DataFrame:
        """A row of each key that is also ``among`` those, in buckets of it, so that joins on it move
        the other side only. The rows are dealt once, for the buckets."""
        count = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        title = f"{name}_{uuid.uuid4().hex}"
        self.put_tables.append(title)
        dealt = table.repartition(count, key).join(among.select(key), key, "left_semi")
        writer = dealt.dropDuplicates([key]).write.bucketBy(count, key).sortBy(key)
        with shuffles_removed(self.spark):
            writer.option("path", f"{self.folder}/{name}").saveAsTable(title)
        return self.spark.table(title)

    def forget(self) -> None:
        """Take the bucketed tables out of the catalog; their files stay in the folder."""
        for title in self.put_tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {title}")


def _sets(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``class_id, tokens, bitmap`` of the documents of ``wanted`` (``doc, class_id``); a key that
    occurs with several texts brings them all."""
    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = list(shingle_sets(list(batch["text"])))
            out = pd.DataFrame(
                {"class_id": map(_class_id, found), "tokens": [f.tobytes() for f in found]}
            ).astype({"class_id": "int64"})
            yield out.assign(bitmap=[_bitmap(f) for f in found])

    held = texts.join(wanted.select("doc"), texts["doc"].eqNullSafe(wanted["doc"]), "left_semi")
    return held.select("text").mapInPandas(
        hashed, "class_id bigint, tokens binary, bitmap array<bigint>"
    )


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, linked`` of candidate pairs, from their whole sets."""
    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            links = []
            for one, other in zip(batch["tokens_a"], batch["tokens_b"]):
                x, y = np.frombuffer(one, "uint64"), np.frombuffer(other, "uint64")
                at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                both = int((x[at] == y).sum())
                links.append(100 * both >= 75 * (len(x) + len(y) - both))
            yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "linked": links})

    side = lambda k: sets.select(F.col("class_id").alias(k), F.col("tokens").alias(f"tokens_{k}"))
    return pairs.join(side("b"), "b").join(side("a"), "a").select(
        "a", "b", "tokens_a", "tokens_b"
    ).mapInPandas(verify, "a bigint, b bigint, linked boolean")


def components(edges: DataFrame, store: _Store, name: str) -> DataFrame:
    """``node, component`` (its smallest node) of every node of ``edges`` (``a, b``).

    Every round each node moves to the least node at most two edges away, and the edges between
    places that still differ are the next round's, until there are none. What is least goes by a
    hash of the round, so that a round leaves a fraction of the nodes, whatever they are linked to:
    rounds grow with the logarithm of a component's size, and each has fewer nodes than the one
    before. The moves are then followed back from the last. Every round is written.
    """
    edges = store.put(f"{name}-edges-0", edges.where("a <> b").select("a", "b").union(
        edges.where("a <> b").select("b", "a")
    ).distinct())
    moves: list[DataFrame] = []
    while edges.limit(1).count():
        step = len(moves)
        ranked = lambda c, k=step: F.struct(F.xxhash64(c, F.lit(k)).alias("h"), F.col(c).alias("id"))
        near = store.put(f"{name}-near-{step}", edges.groupBy("a").agg(
            F.min(ranked("b")).alias("other")
        ).select(F.col("a").alias("node"), F.least("other", ranked("a")).alias("least")))
        far = edges.join(near, edges["b"] == near["node"]).groupBy("a").agg(
            F.min("least").alias("other")
        )
        moves.append(store.put(f"{name}-moves-{step}", far.join(near, far["a"] == near["node"]).select(
            "node", F.least("other", "least")["id"].alias("place")
        )))
        side = lambda k, m=moves[-1]: m.select(F.col("node").alias(k), F.col("place").alias(f"to_{k}"))
        edges = store.put(f"{name}-edges-{step + 1}", edges.join(side("a"), "a").join(
            side("b"), "b"
        ).where("to_a <> to_b").select(F.col("to_a").alias("a"), F.col("to_b").alias("b")).distinct())
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    placed = moves.pop()
    for step in range(len(moves) - 1, -1, -1):
        later = placed.select(F.col("node").alias("place"), F.col("place").alias("last"))
        placed = store.put(f"{name}-placed-{step}", moves[step].join(later, "place", "left").select(
            "node", F.coalesce("last", "place").alias("place")
        ))
    lowest = placed.groupBy("place").agg(F.min("node").alias("component"))
    return store.put(name, placed.join(lowest, "place").select("node", "component"))


def _labelled(items: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Adds each class's component so far, itself where it has no link."""
    if labels is None:
        return items.withColumn("component", F.col("class_id"))
    return items.join(labels, items["class_id"] == labels["node"], "left").select(
        *items.columns, F.coalesce("component", "class_id").alias("component")
    )


def _open(items: DataFrame) -> DataFrame:
    """The entries of tokens that classes of different components share."""
    tokens = items.groupBy("token").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    ).where("low <> high").select("token")
    return items.join(tokens, "token", "left_semi")


def _fits(one: str, other: str) -> Column:
    """Whether two sizes allow a link."""
    return 4 * F.least(one, other) >= 3 * F.greatest(one, other)


def _leader_pairs(items: DataFrame, step: int) -> DataFrame:
    """One pair per class at most: with the leader that most of its entries have.

    The leader of an entry is the class with the least hash of this step; where its component is the
    class's own, or the sizes don't fit, the entry proposes nothing.
    """
    rank = F.struct(F.xxhash64("class_id", F.lit(step)).alias("h"), "class_id", "size", "component")
    leaders = items.groupBy("token").agg(F.min(rank).alias("lead"))
    proposed = items.join(leaders, "token").where(
        (F.col("lead.component") != F.col("component"))
    ).withColumn("lead_size", F.col("lead.size")).where(_fits("size", "lead_size"))
    votes = proposed.groupBy("class_id", F.col("lead.class_id").alias("leader")).agg(
        F.count("*").alias("votes")
    )
    best = votes.groupBy("class_id").agg(F.max(F.struct("votes", "leader")).alias("best"))
    one, other = F.col("class_id"), F.col("best.leader")
    return best.select(F.least(one, other).alias("a"), F.greatest(one, other).alias("b")).distinct()


def _remaining_pairs(items: DataFrame, sets: DataFrame) -> DataFrame:
    """Every pair of classes of different components that may link.

    All that two sets share stands at or after the first token they share, so two that link meet at
    a token with ``1 + min(size - place - 1)`` tokens enough for both sizes; a meeting without is
    none, and neither is any after it. Frequent tokens stand last in a prefix, where that leaves few
    meetings. Of those left, ``n`` of them and the last at places ``i`` and ``j``, no more than
    ``n + min(size - place - 1)`` tokens can be shared in all.

    Beside each entry stands a bitmap of its set. Bits in which two differ stand for as many tokens
    of one set alone at least, and two sets that link have a seventh of their tokens so at most.
    """
    words = [F.col("bitmap")[k].alias(f"bits{k}") for k in range(BITMAP)]
    items = items.join(sets.select("class_id", "bitmap"), "class_id").select(*items.columns, *words)
    one = items.select("token", *(F.col(c).alias(f"a_{c}") for c in items.columns[1:]))
    other = items.select("token", *(F.col(c).alias(f"b_{c}") for c in items.columns[1:]))
    rest = F.least(F.col("a_size") - F.col("a_place"), F.col("b_size") - F.col("b_place"))
    apart = sum(F.bit_count(F.col(f"a_bits{k}").bitwiseXOR(F.col(f"b_bits{k}"))) for k in range(BITMAP))
    met = one.join(other, "token").where(
        (F.col("a_class_id") < F.col("b_class_id"))
        & (F.col("a_component") != F.col("b_component"))
        & _fits("a_size", "b_size")
        & ((F.col("a_place") < 0) | (7 * rest >= 3 * (F.col("a_size") + F.col("b_size"))))
        & (7 * apart <= F.col("a_size") + F.col("b_size"))
    )
    met = met.groupBy("a_class_id", "b_class_id", "a_size", "b_size").agg(
        F.count_if(F.col("a_place") >= 0).alias("n"),
        F.max("a_place").alias("i"),
        F.max("b_place").alias("j"),
        F.max(F.col("a_place") < 0).alias("grouped"),
    )
    most = F.col("n") + F.least(F.col("a_size") - F.col("i") - 1, F.col("b_size") - F.col("j") - 1)
    return met.where(
        F.col("grouped") | (7 * most >= 3 * (F.col("a_size") + F.col("b_size")))
    ).select(F.col("a_class_id").alias("a"), F.col("b_class_id").alias("b"))


def _items(shared: DataFrame, classes: DataFrame) -> DataFrame:
    """Index entries of classes: those of their group, and the group itself where it has several.

    A group's own entry has no place (-1): its members share the whole prefix.
    """
    of_group = classes.select("group_id", "class_id")
    own = classes.groupBy("group_id").agg(F.count("*").alias("n")).where("n > 1").select("group_id")
    inside = classes.join(own, "group_id").select(
        F.xxhash64("group_id", F.lit("group")).alias("token"), "class_id",
        F.col("size").cast("int").alias("size"), F.lit(-1).alias("place"),
    )
    return shared.join(of_group, "group_id").select("token", "class_id", "size", "place").union(
        inside
    )


def _settled(store: _Store, items: DataFrame, sets: DataFrame) -> DataFrame | None:
    """``node, component`` of the classes that links lead to, None without any: first by leaders,
    then from all pairs that may still link two components."""
    labels, links, tried, changed = None, None, None, True
    so_far = _labelled(items, labels)
    for step in range(LEADERS + 1):
        if step and changed:
            # Tokens within one component are settled, and so are fewer with every step.
            so_far = store.put(f"open-{step}", _open(_labelled(items, labels)))
            items = so_far.drop("component")
        pairs = _leader_pairs(so_far, step) if step < LEADERS else _remaining_pairs(so_far, sets)
        if tried is not None:
            pairs = pairs.join(tried.select("a", "b"), ["a", "b"], "left_anti")
        pairs = store.put(f"pairs-{step}", pairs)
        found = store.put(f"verified-{step}", _linked(pairs, sets))
        tried = found if tried is None else tried.union(found)
        links = tried.where("linked").select("a", "b")
        changed = found.where("linked").limit(1).count() > 0
        if changed:
            labels = components(links, store, f"components-{step}")
    return labels


def join(
    docs: DataFrame, key: str = "doc_id", text: str = "text", folder: str | None = None
) -> DataFrame:
    """``key, n_shingles, component_id, class_id, text_hash, place`` of every document.

    ``component_id`` is the smallest key that links lead to, its own included; ``class_id`` is the
    same for equal sets. A null or empty text, or one without words, has no shingle and no link, and
    stands for itself. Repeated rows are copies of each other; a null key is never the smallest.
    ``text_hash`` tells the texts of one key apart, and ``place`` the components. Other columns are not read; an empty table gives
    no rows.
    Intermediate tables go to ``folder`` in the shared space.
    """
    spark = docs.sparkSession
    let_workers_import(spark)
    store = _Store(spark, folder)
    texts = _texts(docs, key, text)
    # Every step that runs Python runs here; what is returned reads the written tables only.
    with batches_of(spark, ROWS):
        order = Order(_frequent(texts))
        profiles = store.put("profiles", _profiles(texts, order))
        classes = store.put("classes", profiles.where("class_id IS NOT NULL").groupBy(
            "class_id", "group_id", "size"
        ).agg(F.min("doc").alias("doc")))
        shared = _shared(_entries(texts, order))
        items = store.put("items", _items(shared, classes))
        wanted = classes.join(items.select("class_id").distinct(), "class_id", "left_semi")
        sets = store.put_bucketed("sets", _sets(texts, wanted), "class_id", wanted)
        try:
            labels = _settled(store, items, sets)
        finally:
            store.forget()
    known = profiles.select("doc", "size", "class_id", "text_hash")
    placed = _labelled(known, labels).withColumnRenamed("component", "place")
    lowest = placed.where("place IS NOT NULL").groupBy("place").agg(F.min("doc").alias("lowest"))
    return placed.join(lowest, "place", "left").select(
        F.col("doc").alias(key),
        F.col("size").alias("n_shingles"),
        F.coalesce("lowest", "doc").alias("component_id"),
        "class_id",
        "text_hash",
        "place",
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each component, as it is: that of the smallest key, null last, and of
    one key's rows that of the smallest hash of its text. Of rows equal in both, one. Rows without
    words are linked with nothing, and all stay.
    """
    groups = join(docs, key, text).where("n_shingles > 0")
    order = F.struct(F.col(key).isNull(), F.col(key).alias("key"), F.col("text_hash").alias("hash"))
    kept = groups.groupBy("place").agg(F.min(order).alias("first")).select(
        F.col("first.key").alias("kept_key"), F.col("first.hash").alias("kept_hash")
    )
    hashed = F.xxhash64(whole_text(text))
    rows = docs.withColumn("kept_text_hash", hashed)
    worded = F.regexp_like(whole_text(text), F.lit(WORD))
    same = F.col(key).eqNullSafe(F.col("kept_key")) & (F.col("kept_text_hash") == F.col("kept_hash"))
    held = rows.where(worded).join(kept, same, "left_semi").dropDuplicates([key, "kept_text_hash"])
    return held.unionByName(rows.where(~worded)).drop("kept_text_hash")
