"""Join documents whose sets of word shingles have a Jaccard similarity of at least a share.

Candidates have to share prefix tokens under several global orders of the
shingles.  With similarity ``percent / 100`` a partner holds at least
``need(n)`` of a document's ``n`` shingles, so in any order common to all
documents the first ``n - need(n) + k`` shingles of both hold ``k`` shared ones.

1. *Hash order.*  Only the prefixes of all documents are gathered, with a
   somewhat longer prefix that asks for several shared shingles.  Tasks send
   packed blocks of hashes to buckets by hash; a bucket finds which occur in more
   than one set.  A document with too few drops out; no pairs are made.
2. *Rarity order.*  Shingles of those left are ordered by the number of sets that
   hold them.  Shingles in one set come first and cannot be shared, so a prefix
   of them alone ends a document.  What is left of the prefixes is an inverted
   index.
3. Pairs out of the index must also share prefix shingles in the hash order and in
   a *second hash order* before their full sets are compared.

Documents with equal sets are one class and are compared once.  Pairs are only
made where they can join two components and can be similar by their sizes and the
places of a shared shingle: in every list of the index the smallest document is
compared with the others, then lists that still hold several
components go on with the next 64 documents against the others, then 512, and
so on, until every pair in a list is either compared or known to be connected.  A pair
that shares many shingles is made in the list of the first one only.  So a
large group of near copies costs about one comparison per document.

Contract: A-Z count as a-z; words are runs of characters other than ASCII white
space; a text with fewer words than a shingle, but not none, has its whole
sequence as one shingle; null texts and texts without words have none and link
with nothing.  Repeated rows are equal sets and link.  Equal doc_ids of different
texts are different documents.  Columns other than ``doc_id`` and ``text`` are not used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenmill.llm.components import components
from tokenmill.llm.tables import beside, columns_of, partitions, small_or_shuffled
from tokenmill.llm.text import blocks, mix, shingles, word_hashes
from tokenmill.staging import collecting, remove_staged, stage

UNIT_ROWS = 500_000
BUCKET_ROWS = 500_000
SETS_TOGETHER = 2_000
SHARDS = 256
EARLIER = 8
SECOND_ORDER = np.uint64(0xA0761D6478BD642F)
SET_SALT = np.uint64(0xE7037ED1A0B428DB)
MANY = np.uint64(0)


@dataclass(frozen=True)
class JoinSettings:
    width: int = 5
    percent: int = 75
    extra: int = 15  # per cent of a set that the hash-order prefix is longer


def need(n, percent: int):
    """Shingles of a set of ``n`` that a partner holds at least."""
    return (percent * n + 99) // 100


def asked(n, settings: JoinSettings):
    """Shared shingles that a longer prefix is made for."""
    return 1 + settings.extra * n // 100


def prefix_length(n, settings: JoinSettings):
    return n - need(n, settings.percent) + asked(n, settings)


def text_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """For each text its distinct shingle hashes, sorted."""
    for _, _, raw, offsets in blocks(column):
        hashes, places = shingles(*word_hashes(raw, offsets), width)
        for start, end in zip(places[:-1].tolist(), places[1:].tolist(), strict=True):
            own = np.sort(hashes[start:end])
            if len(own) > 1:
                own = own[np.concatenate([[True], own[1:] != own[:-1]])]
            yield own


def signature(own: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart, as two signed numbers."""
    with np.errstate(over="ignore"):
        one = mix(own ^ SET_SALT).sum(dtype=np.uint64)
        two = mix(own + SET_SALT).sum(dtype=np.uint64)
    one = one if one != MANY else np.uint64(1)
    return int(one.astype(np.int64)), int(two.astype(np.int64))


def text_key() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key")


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """``(row, doc_id, text_key, n, one, two)`` of every row; ``row`` numbers the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            found = [(len(own), *signature(own)) for own in text_sets(batch.column(1), width)]
            n, one, two = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + len(found))),
                    batch.column(0),
                    batch.column(2),
                    *[pa.array(values, pa.int64()) for values in (n, one, two)],
                ],
                ["row", "doc_id", "text_key", "n", "one", "two"],
            )
            row += len(found)

    schema = "row bigint, doc_id bigint, text_key bigint, n bigint, one bigint, two bigint"
    return docs.select(F.col("doc_id").cast("bigint"), "text", text_key()).mapInArrow(run, schema)


class _Unit:
    """The hash-order prefixes of a task's texts, packed for the buckets."""

    def __init__(self, name: int, buckets: int):
        self.name, self.buckets = name, buckets
        self.tokens: list[np.ndarray] = []
        self.seen: dict[int, int] = {}
        self.sizes: list[int] = []
        self.held = 0

    def add(self, own: np.ndarray, sign: int, length: int) -> None:
        if sign not in self.seen:
            self.seen[sign] = len(self.seen)
            self.tokens.append(own[:length].copy())
            self.sizes.append(length)
            self.held += length

    def rows(self) -> Iterator[dict]:
        """A row per bucket: each token once, with its set, or ``MANY`` if in several.

        Sets that share a token inside the unit are counted here already.
        """
        signs = np.array(list(self.seen), np.int64).view(np.uint64)
        tokens = np.concatenate([np.zeros(0, np.uint64), *self.tokens])
        owner = np.repeat(np.arange(len(signs)), self.sizes)
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        first = np.ones(len(tokens), dtype=bool)
        first[1:] = tokens[1:] != tokens[:-1]
        alone = first.copy()
        alone[:-1] &= first[1:]
        counts = np.bincount(owner[~alone], minlength=len(signs))
        keys = np.where(alone, signs[owner], MANY)[first] if len(tokens) else tokens
        tokens = tokens[first]
        bucket = (tokens & np.uint64(0xFFFFF)) % np.uint64(self.buckets)
        prints = (tokens >> np.uint64(20)).astype(np.uint32)
        counted = np.flatnonzero(counts)
        home = signs[counted] % np.uint64(self.buckets)
        by_bucket = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[by_bucket], np.arange(self.buckets + 1, dtype=np.uint64))
        for b in range(self.buckets):
            own = by_bucket[edges[b] : edges[b + 1]]
            local = counted[home == b]
            if len(own) or len(local):
                yield {
                    "bucket": b,
                    "unit": self.name,
                    "prints": prints[own].tobytes(),
                    "sets": keys[own].tobytes(),
                    "local": signs[local].tobytes(),
                    "counts": counts[local].astype(np.int32).tobytes(),
                }


PACKED = "bucket int, unit bigint, prints binary, sets binary, local binary, counts binary"


def packed_prefixes(docs: DataFrame, settings: JoinSettings, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 20
        unit = _Unit(base, buckets)
        schema = pa.schema(
            [("bucket", pa.int32()), ("unit", pa.int64())]
            + [(name, pa.binary()) for name in ("prints", "sets", "local", "counts")]
        )

        def sent() -> Iterator[pa.RecordBatch]:
            for row in unit.rows():
                yield pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for own in text_sets(batch.column(0), settings.width):
                if len(own):
                    unit.add(own, signature(own)[0], prefix_length(len(own), settings))
                if unit.held > UNIT_ROWS:
                    yield from sent()
                    unit = _Unit(unit.name + 1, buckets)
        yield from sent()

    return docs.select("text").mapInArrow(run, PACKED)


def _shared(key: tuple, rows: pa.Table) -> pa.Table:
    """In a bucket: for each unit and set, how many tokens other sets hold too, packed by shard."""

    def numbers(name: str, kind) -> tuple[np.ndarray, np.ndarray]:
        parts = [np.frombuffer(value, kind) for value in rows[name].to_pylist()]
        return np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])

    units = rows["unit"].to_numpy()
    prints, row = numbers("prints", np.uint32)
    sets, _ = numbers("sets", np.uint64)
    order = np.argsort(prints, kind="stable")
    prints, sets, row = prints[order], sets[order], row[order]
    starts = np.flatnonzero(np.concatenate([[True], prints[1:] != prints[:-1]])[: len(prints)])
    if len(prints):
        low = np.minimum.reduceat(sets, starts)
        high = np.maximum.reduceat(sets, starts)
        length = np.diff(np.concatenate([starts, [len(prints)]]))
        hit = np.repeat(low != high, length) & (sets != MANY)
    else:
        hit = np.zeros(0, dtype=bool)
    local, local_row = numbers("local", np.uint64)
    counts, _ = numbers("counts", np.int32)
    names = np.concatenate([sets[hit], local])
    rows_of = np.concatenate([row[hit], local_row])
    weight = np.concatenate([np.ones(int(hit.sum()), np.int64), counts.astype(np.int64)])
    shard = (names % np.uint64(SHARDS)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    names, units, weight = names[order], units[rows_of][order], weight[order]
    edges = np.searchsorted(shard[order], np.arange(SHARDS + 1))
    parts = [(i, slice(edges[i], edges[i + 1])) for i in range(SHARDS) if edges[i] < edges[i + 1]]
    return pa.table(
        {
            "shard": pa.array([i for i, _ in parts], pa.int32()),
            "sets": pa.array([names[at].tobytes() for _, at in parts], pa.binary()),
            "units": pa.array([units[at].tobytes() for _, at in parts], pa.binary()),
            "counts": pa.array([weight[at].tobytes() for _, at in parts], pa.binary()),
        }
    )


def _summed(key: tuple, rows: pa.Table) -> pa.Table:
    """The shared tokens of each set of a shard, summed over buckets.

    A set that several units hold is counted in each of them alike.
    """
    numbers = [
        np.concatenate([np.frombuffer(value, kind) for value in rows[name].to_pylist()])
        for name, kind in (("sets", np.uint64), ("units", np.int64), ("counts", np.int64))
    ]
    order = np.lexsort((numbers[1], numbers[0]))
    sets, units, counts = (values[order] for values in numbers)
    new = np.ones(len(sets), dtype=bool)
    new[1:] = (sets[1:] != sets[:-1]) | (units[1:] != units[:-1])
    at = np.flatnonzero(new)
    total, sets = np.add.reduceat(counts, at), sets[at]
    first = np.flatnonzero(np.concatenate([[True], sets[1:] != sets[:-1]]))
    return pa.table(
        {
            "one": pa.array(sets[first].view(np.int64)),
            "shared": pa.array(np.maximum.reduceat(total, first)),
        }
    )


def _kept_sets(width: int):
    """The sets of rows whose signature is the one they were joined for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), SETS_TOGETHER):
                batch = whole.slice(at, SETS_TOGETHER)
                names, ones, twos = (batch.column(i).to_pylist() for i in (0, 2, 3))
                sets = text_sets(batch.column(1), width)
                nodes, found = [], []
                for node, own, one, two in zip(names, sets, ones, twos, strict=True):
                    if signature(own) == (one, two):
                        nodes.append(node)
                        found.append(own.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                    ["node", "tokens"],
                )

    return run


def _hash_prefixes(own: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    length = len(own) - need(len(own), percent) + 1
    return own[:length], np.sort(mix(own ^ SECOND_ORDER))[:length]


def common(one: np.ndarray, two: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    place = np.searchsorted(one, two)
    place[place == len(one)] = 0
    return int((one[place] == two).sum())


def similar(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets pass the filters of both hash orders and the similarity."""
    small, large = sorted((len(one), len(two)))
    if 100 * small < percent * large or not small:
        return False
    for a, b in zip(_hash_prefixes(one, percent), _hash_prefixes(two, percent), strict=True):
        if not common(a, b):
            return False
    both = common(one, two)
    return 100 * both >= percent * (small + large - both)


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = []
            for column in (batch.column(2), batch.column(3)):
                values = column.values.to_numpy().view(np.uint64)
                sets.append((values, column.offsets.to_numpy()))
            (left, l_at), (right, r_at) = sets
            keep = [
                similar(left[l_at[i] : l_at[i + 1]], right[r_at[i] : r_at[i + 1]], percent)
                for i in range(len(batch))
            ]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def with_earlier(lists: DataFrame) -> DataFrame:
    """The lists with ``earlier``, the node's last ``EARLIER`` shingles before in rarity order."""
    order = Window.partitionBy("node").orderBy(F.desc("rest")).rowsBetween(-EARLIER, -1)
    return lists.withColumn("earlier", F.collect_list("token").over(order))


class NgramJoin:
    """The join of one table with itself."""

    def __init__(self, docs: DataFrame, settings: JoinSettings | None = None):
        self.settings = settings or JoinSettings()
        self.docs = docs
        self.spark = docs.sparkSession
        self.rows = stage(signatures(docs, self.settings.width), "sets")
        self.classes = stage(
            self.rows.where("n > 0")
            .groupBy("one", "two", "n")
            .agg(F.min("row").alias("node"), F.min("doc_id").alias("least")),
            "classes",
        )

    def after_hash_order(self) -> DataFrame:
        """Classes whose hash-order prefix shares enough shingles with other classes."""
        n = F.col("n")
        percent, extra = self.settings.percent, self.settings.extra
        held = F.floor((percent * n + 99) / 100)
        total = self.classes.agg(
            F.coalesce(F.sum(n - held + 1 + F.floor(extra * n / 100)), F.lit(0)).alias("total")
        ).first()["total"]
        buckets = max(partitions(self.spark), -(-total // BUCKET_ROWS))
        shared = (
            packed_prefixes(self.docs, self.settings, buckets)
            .groupBy("bucket")
            .applyInArrow(_shared, "shard int, sets binary, units binary, counts binary")
            .groupBy("shard")
            .applyInArrow(_summed, "one bigint, shared bigint")
        )
        # A partner has at least as many shingles as it must hold of these.
        enough = F.floor(extra * held / 100) + 1
        return stage(
            self.classes.join(shared, "one").where(F.col("shared") >= enough), "classes-hash"
        )

    def sets_of(self, chosen: DataFrame) -> DataFrame:
        """``(node, tokens)`` with the shingles of one row of each chosen class."""
        wanted = small_or_shuffled(
            chosen.select(F.col("least").alias("_id"), "node", "one", "two"), "wanted"
        )
        rows = self.docs.select(F.col("doc_id").cast("bigint").alias("_doc"), "text").join(
            wanted, F.col("_doc").eqNullSafe(F.col("_id"))
        )
        found = stage(
            rows.select("node", "text", "one", "two").mapInArrow(
                _kept_sets(self.settings.width), "node bigint, tokens array<bigint>"
            ),
            "token-sets",
        )
        if found.count() != chosen.count():  # a doc_id or a row occurs more than once
            found = stage(found.dropDuplicates(["node"]), "token-sets")
        return found

    def index(self, sets: DataFrame) -> DataFrame:
        """The inverted index of the rarity-order prefixes.

        Beside token, node and ``n`` it has ``rest``, the shingles from this one on in
        the order, and ``before``, those before it that other sets hold too.
        """
        tokens = sets.select(
            F.explode("tokens").alias("token"), "node", F.size("tokens").alias("n")
        )
        often = stage(
            tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "often"
        )
        # From the end of the order: most frequent first, shingles of one set not at all.
        whole = Window.partitionBy("node")
        last_first = whole.orderBy(F.desc("df"), F.desc("token"))
        held = F.floor((self.settings.percent * F.col("n") + 99) / 100)
        return stage(
            tokens.join(often, "token")
            .withColumn("rest", F.row_number().over(last_first))
            .withColumn("before", F.count("*").over(whole) - F.col("rest"))
            .where(F.col("rest") >= held)
            .select("token", "node", "n", "rest", "before"),
            "rarity-index",
        )

    def verify(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("b_tokens"))
        left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("a_tokens"))
        joined = pairs.join(right, "b").join(left, "a")
        return joined.select("a", "b", "a_tokens", "b_tokens").mapInArrow(
            _verified(self.settings.percent), "a bigint, b bigint"
        )

    def near_size(self) -> Column:
        """Length and positional filter: what two sets can share at most, given a shared shingle."""
        percent = self.settings.percent
        most_shared = F.least("rest", "a_rest") + F.least("before", "a_before")
        return (100 * F.least("n", "a_n") >= percent * F.greatest("n", "a_n")) & (
            (100 + percent) * most_shared >= percent * (F.col("n") + F.col("a_n"))
        )

    def open_pairs(self, open_lists: DataFrame, done: int, turn: int) -> DataFrame:
        """In each list the nodes from ``done`` to ``turn`` with those after them, if not connected.

        Two sets share many shingles.  Their pair is made for the first of them in the rarity
        order; other lists drop it where one of the last shingles before theirs is in both
        sets.  Only shingles of open lists count, and as long as two nodes are not connected all
        their lists are open, so the first one makes their pair in one of the turns.
        """
        # A node's place in the order, as a share; the first of a list are its lowest.
        share = F.pmod(F.col("order"), F.lit(1 << 40)) / float(1 << 40)
        until = F.col("size") * share < turn
        since = (F.col("size") * share >= done) if done > 1 else F.lit(True)
        first = open_lists.where(until & since).select(
            "token",
            F.col("node").alias("a"),
            F.col("n").alias("a_n"),
            F.col("rest").alias("a_rest"),
            F.col("before").alias("a_before"),
            share.alias("a_share"),
            F.col("component").alias("a_component"),
            F.col("earlier").alias("a_earlier"),
        )
        later = (F.struct(share, F.col("node"))) > (F.struct("a_share", "a"))
        apart = F.col("component") != F.col("a_component")
        made_before = F.arrays_overlap("earlier", "a_earlier")
        return (
            open_lists.join(first, "token")
            .where(later & self.near_size() & apart & ~made_before)
            .select("a", F.col("node").alias("b"))
        )

    def links(self) -> DataFrame | None:
        """Enough verified links ``(a, b)`` between classes to connect all that are connected."""
        chosen = self.after_hash_order()
        if not chosen.count():
            return None
        sets = self.sets_of(chosen)
        index = self.index(sets).withColumn("order", F.xxhash64("node"))
        # The smallest set of a list is compared first: where sets share one passage, it
        # holds the least beside it and is similar to all that are similar to any.
        lists = stage(
            index.groupBy("token").agg(
                F.count("*").alias("size"),
                F.min(F.struct("n", "order", "node", "rest", "before")).alias("head"),
            ).where("size > 1"),
            "lists",
        )
        most = lists.agg(F.max("size").alias("most")).first()["most"] or 0
        heads = lists.select(
            "token",
            F.col("head.node").alias("a"),
            F.col("head.n").alias("a_n"),
            F.col("head.rest").alias("a_rest"),
            F.col("head.before").alias("a_before"),
        )
        pairs = (
            index.join(heads, "token")
            .where((F.col("node") != F.col("a")) & self.near_size())
            .select("a", F.col("node").alias("b"))
            .distinct()
        )
        found = stage(self.verify(pairs, sets), "verified")
        done, turn = 1, 64
        while done < most and most > 2:
            named = components(found)
            name = small_or_shuffled(named, "component-names")
            known = index.join(name, "node", "left").withColumn(
                "component", F.coalesce("component", "node")
            )
            several = (
                known.groupBy("token")
                .agg(
                    F.count("*").alias("size"),
                    F.min("component").alias("low"),
                    F.max("component").alias("high"),
                )
                .where("low <> high")
                .select("token", "size")
            )
            open_lists = stage(with_earlier(known.join(several, "token")), "open-lists")
            if not open_lists.count():
                break
            pairs = self.open_pairs(open_lists, done, turn).distinct()
            found = found.unionByName(stage(self.verify(pairs, sets), "verified"))
            done, turn = turn, turn * 8
        return found

    def named_rows(self) -> DataFrame:
        """The rows with ``component_id``, the least doc_id of their component, and ``component``.

        ``component`` tells components apart, which a doc_id that several of them hold
        does not.  Both are null for rows without shingles.
        """
        with collecting() as made:
            links = self.links()
            classes = self.classes
            if links is not None:
                names = components(links)
                named = classes.join(names, "node", "left").withColumn(
                    "component", F.coalesce("component", "node")
                )
                least = named.groupBy("component").agg(F.min("least").alias("component_id"))
                classes = named.join(least, "component")
            else:
                classes = classes.withColumn("component", F.col("node")).withColumn(
                    "component_id", F.col("least")
                )
            found = small_or_shuffled(
                classes.select("one", "two", "n", "component", "component_id"), "groups"
            )
        remove_staged(self.spark, made, [found])
        return self.rows.join(found, ["one", "two", "n"], "left")

    def groups(self) -> DataFrame:
        """``(row, doc_id, n, component_id)``: the least doc_id of each row's component."""
        return self.named_rows().select(
            "row", "doc_id", "n", F.coalesce("component_id", "doc_id").alias("component_id")
        )

    def one_of_each(self) -> DataFrame:
        """Of each component the row with the least ``doc_id``, all columns unchanged.

        Rows without shingles stay.  A row with a null ``doc_id`` goes if its component
        has a row with one.  Of several rows with the least ``doc_id`` the one with the
        least hash of its text stays, and of rows equal in both the one with the least
        hash of all columns.
        """
        first = F.col("doc_id").eqNullSafe(F.col("component_id"))
        texts = (
            self.named_rows()
            .where((F.col("n") > 0) & first)
            .groupBy("component", "component_id", "text_key")
            .agg(F.count("*").alias("rows"))
        )
        kept = texts.groupBy("component", "component_id").agg(
            F.min(F.struct("text_key", "rows")).alias("text")
        )
        kept = kept.select(F.col("component_id").alias("doc_id"), "text.*")
        plain = self.rows.where("n = 0").select("doc_id", "text_key").distinct()
        kept = stage(kept.unionByName(plain.withColumn("rows", F.lit(1).cast("bigint"))), "kept")

        def held(keys: DataFrame, label: str) -> DataFrame:
            keys = small_or_shuffled(keys.select("doc_id", "text_key"), label)
            return beside(self.docs, keys, text_key(), "left_semi")[0]

        docs = held(kept.where("rows = 1"), "kept-single")
        several = kept.where("rows > 1")
        if several.isEmpty():
            return docs
        whole = F.struct(*columns_of(self.docs))
        alone = (
            held(several, "kept-several")
            .groupBy(F.col("doc_id").cast("bigint").alias("_id"), text_key().alias("_key"))
            .agg(F.min_by(whole, F.xxhash64(F.to_json(whole))).alias("_row"))
            .select("_row.*")
        )
        return docs.unionByName(alone)
