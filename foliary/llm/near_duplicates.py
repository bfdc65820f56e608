"""N-gram Jaccard join by MinHash banding, verified on the full n-gram sets, without a row for each pair of a group.

Texts are sets of five-word shingles (a text of one to four words is one shingle); two texts are linked at a Jaccard
similarity of 0.8 or more. Documents of one word sequence are copies and stand for one *text*, known by 128 bits of its words,
whatever its documents' ids are; ids, of any type, only label texts and classes in the result. Band and row counts follow from the
recall wanted at the threshold. Then:

1. each text is compared with the leader of each of its buckets (stars, not all pairs): of the bucket's texts the one with most company in
   all its buckets, so of copies with edits of their own the one in the middle. The verified links join texts to groups;
2. two texts of one bucket that are in different groups are compared by rarity: of two sets at the threshold or above, the rarest
   fifths (in any one order of the shingles) have a shingle in common, and what precedes the first of these is no more than
   the sets may differ by. So texts are joined on the rarest fifth of their shingles, by how many such texts hold them: first as
   stars, which join groups, again with other leaders while many pairs are left, then as all pairs of what is still apart, each once,
   at its first common shingle. A passage that many texts share is no reason to compare them, and no pair is lost;
3. links within a group are counted in blocks of texts, where counts are asked for: a task takes two blocks, multiplies their shingle
   matrices and returns one number for each text, not a row for each pair. A text is sent as what it has and lacks against
   its group's first text, so near copies are sent as a few numbers. Near copies that lie about the threshold leave no other way
   to an exact count; a group of m texts takes m^2 / BLOCK_TEXTS such rows. Classes alone (count_links=False) need no such step.

So every pair of different texts that shares a bucket is verified. Null, empty and wordless texts have no links and are
classes of their own. Rows that repeat an id are judged each by its own text; rows without an id are matched like others, and label
a copy or class with null only if none of its documents has an id. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary.llm.frames import Held, aside, map_text, written
from foliary.llm.kernels import Words, mix

WORDS = 5
#: Linked if 9 * intersection >= 4 * (size + size): a similarity of 0.8 or more, in whole numbers.
THRESHOLD = 0.8
RECALL = 0.9999
MOST_HASHES = 96
#: Ids up to this many (16 MB) are broadcast; more are joined by shuffle.
BROADCAST_IDS = 2_000_000
#: Most texts of a block when the links of a group are counted, and shingles in which they differ from the group's first text;
#: a text that differs by more is a block of its own. Cells of the matrices that are multiplied at once.
BLOCK_TEXTS, BLOCK_GRAMS = 4096, 1 << 21
_CELLS = 1 << 23
_SEED = 20_011
#: Rounds of stars go on (so many at most) while shingles that groups share would give more pairs than so many times their rows.
STAR_ROUNDS, FEW_PAIRS = 2, 2


def bands_and_rows(threshold: float = THRESHOLD, recall: float = RECALL, most_hashes: int = MOST_HASHES) -> tuple[int, int]:
    """The most selective banding within the hash budget that finds a pair at the threshold with the recall wanted."""
    best = None
    for rows in range(1, most_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows)))
        if bands * rows <= most_hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("no banding within the hash budget reaches this recall")
    return best


def shingles(words: Words, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts in order, and the number of each text's."""
    h = words.hashes()
    g, at = words.windows(h, k)
    owner = np.searchsorted(words.first, at, "right") - 1
    short = []
    for n in range(1, k):
        if (words.count == n).any():
            s, i = words.windows(h, n)
            d = np.searchsorted(words.first, i, "right") - 1
            whole = words.count[d] == n
            short.append((s[whole], d[whole]))
    if short:
        g, owner = np.concatenate([g, *(s for s, _ in short)]), np.concatenate([owner, *(d for _, d in short)])
        order = np.argsort(owner, kind="stable")
        g, owner = g[order], owner[order]
    return g, np.bincount(owner, minlength=len(words.count))


def _prints(words: Words) -> list[pa.Array]:
    """128 bits of each text's word sequence in two numbers; null without words."""
    out = []
    place = (np.arange(len(words.start)) - np.repeat(words.first[:-1], words.count)).astype(np.uint64)
    for seed in (1, 2):  # words are hashed anew for either number
        total = np.zeros(len(place) + 1, np.uint64)
        np.cumsum(mix(words.hashes(seed) + place * np.uint64(0x9E3779B97F4A7C15)), out=total[1:])
        out.append(pa.array((total[words.first[1:]] - total[words.first[:-1]]).view(np.int64), mask=words.count == 0))
    return out


_PRINT = [("f1", "bigint"), ("f2", "bigint")]


def _signatures(documents: DataFrame, doc_id: str, text: str, bands: int, rows: int) -> DataFrame:
    """doc_id, f1 and f2 (the word sequence; null without words), bands (a key for each band)."""
    odd = np.random.default_rng(_SEED).integers(0, 1 << 63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)

    def make():
        def kernel(texts):
            words = Words(texts)
            g, count = shingles(words)
            full = np.flatnonzero(count)
            first = np.concatenate([[0], np.cumsum(count)])[full]
            keys = np.zeros((len(full), bands), np.uint64)
            scaled = np.empty_like(g)
            for j, a in enumerate(odd):
                np.multiply(g, a, out=scaled)
                if len(full):
                    keys[:, j // rows] = mix(keys[:, j // rows] + np.minimum.reduceat(scaled, first))
            keys = mix(keys + np.arange(1, bands + 1, dtype=np.uint64))
            offsets = np.concatenate([[0], np.cumsum(np.where(count > 0, bands, 0))]).astype(np.int32)
            return [*_prints(words), pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.view(np.int64).ravel()))]

        return kernel

    return map_text(documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")), make, [*_PRINT, ("bands", "array<bigint>")])


def _sets(documents: DataFrame, text: str) -> DataFrame:
    """f1, f2 and the sorted distinct shingle hashes of the whole text."""

    def make():
        def kernel(texts):
            words = Words(texts)
            g, count = shingles(words)
            parts = [np.unique(x) for x in np.split(g, np.cumsum(count)[:-1])] if len(count) else []
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
            return [*_prints(words), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)))]

        return kernel

    return map_text(documents, make, [*_PRINT, ("grams", "array<bigint>")], text=text, keep=())


def beside(df: DataFrame, table: DataFrame, on, how: str) -> DataFrame:
    """df joined with a written table: broadcast if its rows are few, by shuffle otherwise."""
    return df.join(F.broadcast(table) if table.count() <= BROADCAST_IDS else table, on, how)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, both sizes and the intersection of their sets."""
    left = sets.select(F.col("text_id").alias("a"), F.col("grams").alias("ga"))
    right = sets.select(F.col("text_id").alias("b"), F.col("grams").alias("gb"))
    near = F.col("both") * 9 >= (F.col("na") + F.col("nb")) * 4
    return pairs.join(right, "b").join(left, "a").select("a", "b", F.size("ga").alias("na"), F.size("gb").alias("nb"), F.size(F.array_intersect("ga", "gb")).alias("both")).withColumn("linked", near)


def _components(edges: DataFrame, held: Held) -> DataFrame:
    """node, root (the least node that links reach): alternating large and small stars until nothing changes.

    edges: a < b. The rows of a round are at most those of the edges; no node's neighbours are gathered in one place.
    """
    edges, before = held(edges.select("a", "b").distinct()), None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("x"), F.col("m").alias("y")).where("x <> y").distinct()
        floor = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(floor, "x")
        new = small.select(F.col("y").alias("u"), F.col("m")).unionByName(small.select(F.col("x").alias("u"), "m")).where("u <> m").distinct()
        edges = held(new.select(F.col("m").alias("a"), F.col("u").alias("b")))
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            return edges.groupBy("b").agg(F.min("a").alias("root")).withColumnRenamed("b", "node")
        before = mark


def _rare_keys(members: DataFrame, groups: DataFrame, sets: DataFrame, held: Held) -> tuple[DataFrame, DataFrame]:
    """Keys (text_id, size, gram, at): a row for each shingle of the rarest fifth of the texts of mixed buckets that another such text holds;
    at is how many rarer ones the text has. And (text_id, rare): those shingles in order. A shingle of one text alone takes its place
    but finds no partner, so it is only counted."""
    placed = members.join(groups, "text_id")
    mixed = placed.groupBy("bucket").agg(F.min("group").alias("x"), F.max("group").alias("y")).where("x <> y").select("bucket")
    wanted = held(placed.join(mixed, "bucket").select("text_id").distinct())
    own = sets.join(wanted, "text_id")
    grams = held(own.select("text_id", F.explode("grams").alias("gram")))
    shared = grams.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1")
    ranked = grams.join(shared, "gram").groupBy("text_id").agg(F.sort_array(F.collect_list(F.struct("n", "gram"))).alias("rare"))
    alone = F.col("size") - F.size("rare")
    first = own.select("text_id", F.size("grams").alias("size")).join(ranked, "text_id").withColumn("alone", alone)
    places = F.col("size") - F.ceil(F.col("size") * THRESHOLD).cast("int") + 1 - F.col("alone")
    first = held(first.select("text_id", "size", "alone", F.slice("rare", 1, F.greatest(places, F.lit(0)))["gram"].alias("rare")))
    keys = first.select("text_id", "size", "alone", F.posexplode("rare").alias("at", "gram"))
    return keys.select("text_id", "size", "gram", (F.col("alone") + F.col("at")).alias("at")), first.select("text_id", "rare")


def _shared_keys(keys: DataFrame, groups: DataFrame) -> DataFrame:
    """The rare keys with their group, of shingles that texts of several groups hold."""
    keys = keys.join(groups, "text_id")
    several = keys.groupBy("gram").agg(F.min("group").alias("x"), F.max("group").alias("y")).where("x <> y").select("gram")
    return keys.join(several, "gram")


def _stars(keys: DataFrame, turn: int) -> DataFrame:
    """a < b: each text of shared keys beside one text of each of its shingles: in the first turn the one with most company, then any."""
    order = F.struct(-F.col("company") if turn == 0 else F.xxhash64("text_id", F.lit(turn)), "text_id")
    leaders = keys.groupBy("gram").agg(F.min_by(F.struct("text_id", "group", "size", "at"), order).alias("l"))
    met = keys.join(leaders, "gram").where(_possible(F.col("group"), F.col("l.group"), F.col("size"), F.col("l.size"), F.col("at"), F.col("l.at")))
    return met.select(F.least("text_id", "l.text_id").alias("a"), F.greatest("text_id", "l.text_id").alias("b")).distinct()


def _possible(ga: Column, gb: Column, na: Column, nb: Column, at: Column, bt: Column) -> Column:
    """Whether texts of two groups can be linked that have a shingle in common after `at` and `bt` rarer ones."""
    return (ga != gb) & (F.least(na - at, nb - bt) * 9 >= (na + nb) * 4)


def _pairs(keys: DataFrame, rare: DataFrame) -> DataFrame:
    """a < b: all pairs of texts in different groups that may be linked by their rare keys, each at its first common shingle."""
    own = keys.join(rare, "text_id")
    names = {"text_id": "", "group": "g", "size": "n", "at": "at", "rare": "r"}
    left, right = (own.select("gram", *[F.col(c).alias(f"{k}{side}") for c, k in names.items()]) for side in "ab")
    met = left.join(right, "gram").where((F.col("a") < F.col("b")) & _possible(F.col("ga"), F.col("gb"), F.col("na"), F.col("nb"), F.col("ata"), F.col("atb")))
    return met.where(F.get(F.array_intersect("ra", "rb"), 0) == F.col("gram")).select("a", "b").distinct()


def _regrouped(groups: DataFrame, links: DataFrame, held: Held) -> DataFrame:
    """The groups after links between their texts."""
    ends = links.join(groups.toDF("a", "ga"), "a").join(groups.toDF("b", "gb"), "b").where("ga <> gb").select(F.least("ga", "gb").alias("a"), F.greatest("ga", "gb").alias("b"))
    roots = _components(ends, held).withColumnRenamed("node", "group")
    return held(groups.join(roots, "group", "left").select("text_id", F.coalesce("root", "group").alias("group")))


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many numbers each set on the left has in common with each on the right."""
    both, grams = [*left, *right], np.concatenate([*left, *right])
    place = np.unique(grams, return_inverse=True)[1]
    owner = np.repeat(np.arange(len(both)), [len(x) for x in both])
    out = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    size, top = max(_CELLS // len(both), 1), int(place[-1]) + 1 if len(place) else 0
    for lo in range(0, top, size):
        a, b = np.searchsorted(place, (lo, lo + size))
        held = np.zeros((len(both), min(size, top - lo)), np.float32)
        held[owner[a:b], place[a:b] - lo] = 1
        out += held[: len(left)] @ held[len(left) :].T
    return out


def _links_within(groups: DataFrame, sets: DataFrame, copies: DataFrame, keep: Held) -> DataFrame:
    """text_id and links: the documents of other texts of its group at the threshold or above.

    Of sets a and b that lack ma and mb shingles of the group's first text, r in number, and have others besides, the
    intersection is r - ma - mb and the numbers that both lack or both have besides.
    """
    many = groups.groupBy("group").agg(F.count("*").alias("n"), F.min("text_id").alias("first")).where("n > 1")
    placed = keep(groups.join(many, "group"))
    reference = sets.join(placed.where("text_id = first").select("text_id", "group", F.ceil(F.col("n") / BLOCK_TEXTS).cast("int").alias("parts")), "text_id").select("group", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("grams").alias("ref"))
    dealt = sets.join(placed.select("text_id", "group", F.pmod(F.xxhash64("text_id"), F.ceil(F.col("n") / BLOCK_TEXTS)).cast("int").alias("part")), "text_id")
    lacks, has = F.array_except("ref", "grams"), F.array_except("grams", "ref")
    full = dealt.join(reference, ["group", "part"]).select("group", "text_id", F.size("grams").alias("size"), (F.size("ref") - 2 * F.size(lacks)).alias("base"), F.concat(lacks, has).alias("grams"))
    full = keep(full.join(copies, "text_id").select("group", "text_id", "copies", "size", "base", "grams"))
    sums = full.groupBy("group").agg(F.count("*").alias("n"), F.sum(F.size("grams").cast("long")).alias("all"))
    blocks = sums.select("group", F.greatest(F.ceil(F.col("n") / BLOCK_TEXTS), F.ceil(F.col("all") / BLOCK_GRAMS)).cast("int").alias("blocks"))
    dealt = full.join(blocks, "group").withColumn("own", F.pmod(F.xxhash64("text_id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = dealt.select("group", "text_id", "copies", "size", "base", "grams", "own", other.alias("other")).select("group", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "text_id", "copies", "size", "base", "grams")

    def count(rows: list[tuple], i: int, j: int) -> tuple[list, list]:
        """rows of one pair of blocks: (own, text_id, copies, size, base, grams)."""
        left, right = [r for r in rows if r[0] == i], [r for r in rows if r[0] != i]
        if i == j:
            right = left
        if not left or not right:
            return [], []
        (na, ba), (nb, bb) = (np.array([(r[3], r[4]) for r in x], np.float64).T for x in (left, right))
        common = _shared([r[5] for r in left], [r[5] for r in right]).astype(np.float64) + (ba[:, None] + bb[None, :]) / 2
        linked = 9 * common >= 4 * (na[:, None] + nb[None, :])
        if i == j:
            np.fill_diagonal(linked, False)
        ids, found = [r[1] for r in left], (linked @ np.array([r[2] for r in right], np.int64)).tolist()
        if i != j:
            ids, found = ids + [r[1] for r in right], found + (np.array([r[2] for r in left], np.int64) @ linked).tolist()
        return ids, found

    def run(batches):
        key, rows = None, []
        for batch in batches:
            group, i, j, *columns = (batch.column(k).to_pylist() for k in range(8))
            grams = batch.column(8)
            flat, at = grams.values.to_numpy(zero_copy_only=False), grams.offsets.to_numpy()
            ids, found = [], []
            for k, own in enumerate(zip(*columns, strict=True)):
                if (group[k], i[k], j[k]) != key:
                    if rows:
                        a, b = count(rows, *key[1:])
                        ids += a
                        found += b
                    key, rows = (group[k], i[k], j[k]), []
                rows.append((*own, flat[at[k] : at[k + 1]].copy()))
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.int64())], names=["text_id", "links"])
        if rows:
            ids, found = count(rows, *key[1:])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.int64())], names=["text_id", "links"])

    ordered = pairs.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j")
    return ordered.mapInArrow(run, "text_id bigint, links bigint").groupBy("text_id").agg(F.sum("links").alias("links"))


def _classes(documents: DataFrame, doc_id: str, text: str, recall: float, most_hashes: int, count_links: bool) -> tuple[DataFrame, DataFrame]:
    """(f1, f2, doc_id) of every row, and a row for each text: f1, f2, text_id, label (its least doc_id), copies, root (its group), links."""
    bands, rows = bands_and_rows(THRESHOLD, recall, most_hashes)
    signed = written(_signatures(documents, doc_id, text, bands, rows))
    texts = signed.where("f1 is not null").groupBy("f1", "f2").agg(F.min("doc_id").alias("label"), F.count("*").alias("copies"), F.first("bands").alias("bands"))
    held = Held(documents.sparkSession)
    texts = held(texts.withColumn("text_id", F.monotonically_increasing_id()))
    keyed = texts.select("text_id", F.explode("bands").alias("bucket"))
    shared = keyed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = held(keyed.join(shared, "bucket"))  # of buckets with two texts or more
    company = held(members.groupBy("text_id").agg(F.sum("n").alias("company")))
    placed = members.join(company, "text_id")
    leaders = placed.groupBy("bucket").agg(F.min_by("text_id", F.struct(-F.col("company"), "text_id")).alias("leader"))
    stars = members.join(leaders, "bucket").where("text_id <> leader")
    stars = held(stars.select(F.least("text_id", "leader").alias("a"), F.greatest("text_id", "leader").alias("b")).distinct())
    wanted = held(texts.join(stars.select(F.explode(F.array("a", "b")).alias("text_id")).distinct(), "text_id").select("f1", "f2", "text_id", "label"))
    labels = held(wanted.select(F.col("label").alias("__label")).distinct())
    given = beside(documents.select(F.col(f"`{doc_id}`").alias("__id"), F.col(f"`{text}`").alias("text")), labels, F.col("__id").eqNullSafe(F.col("__label")), "left_semi")
    sets = held(beside(_sets(given, "text"), wanted.drop("label"), ["f1", "f2"], "inner").select("text_id", "grams").dropDuplicates(["text_id"]))
    groups = _regrouped(wanted.select("text_id", F.col("text_id").alias("group")), held(_verified(stars, sets).where("linked").select("a", "b")), held)
    keys, rare = _rare_keys(members, groups, sets, held)
    keys = keys.join(company, "text_id")
    for turn in range(STAR_ROUNDS):
        open_ = held(_shared_keys(keys, groups))
        met = open_.groupBy("gram").agg(F.count("*").alias("n")).agg(F.sum("n"), F.sum(F.col("n") * F.col("n"))).first()
        if (met[1] or 0) <= FEW_PAIRS * (met[0] or 0):  # whatever is left is compared below
            break
        groups = _regrouped(groups, held(_verified(_stars(open_, turn), sets).where("linked").select("a", "b")), held)
    groups = _regrouped(groups, held(_verified(_pairs(_shared_keys(keys, groups), rare), sets).where("linked").select("a", "b")), held)
    found = texts.drop("bands").join(groups, "text_id", "left").withColumn("root", F.coalesce("group", "text_id")).drop("group")
    if count_links:
        links = _links_within(groups, sets, texts.select("text_id", "copies"), held)
        found = found.join(links, "text_id", "left").withColumn("links", F.col("copies") - 1 + F.coalesce("links", F.lit(0)))
    found = written(found)
    held.clear()
    return signed, found


def near_duplicates(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", recall: float = RECALL, most_hashes: int = MOST_HASHES, count_links: bool = True) -> DataFrame:
    """One row for each row of documents: doc_id, class_id (least doc_id that links reach), copy_id (least doc_id of the
    same word sequence), n_links (other documents at a similarity of 0.8 or more, copies among them; null if they aren't to be counted)."""
    signed, texts = _classes(documents, doc_id, text, recall, most_hashes, count_links)
    several = texts.groupBy("root").agg(F.min("label").alias("class_id"))
    named = written(texts.join(several, "root").select("f1", "f2", "class_id", F.col("label").alias("copy_id"), (F.col("links") if count_links else F.lit(None)).cast("long").alias("n_links")))
    out = signed.select("doc_id", "f1", "f2").join(named, ["f1", "f2"], "left")
    alone = F.col("f1").isNull()
    own = lambda c: F.when(alone, F.col("doc_id")).otherwise(F.col(c)).alias(c)
    return out.select("doc_id", own("class_id"), own("copy_id"), (F.when(alone, 0).otherwise(F.col("n_links")) if count_links else F.col("n_links")).cast("long").alias("n_links"))


def keep_first(documents: DataFrame) -> DataFrame:
    """The documents with one left of each class: that with the least doc_id (any one, of those without), once. Rows are told by their
    words, so of rows that share an id only those go that are copies or near copies of another."""
    signed, texts = _classes(documents, "doc_id", "text", RECALL, MOST_HASHES, False)
    first = texts.groupBy("root").agg(F.min(F.struct(F.col("label").isNull().alias("none"), "label", "text_id"))["text_id"].alias("first"), F.sum("copies").alias("size")).where("size > 1")
    marks = written(texts.join(first, "root").select(F.col("f1").alias("__f1"), F.col("f2").alias("__f2"), F.col("label").alias("__label"), (F.col("text_id") == F.col("first")).alias("__first")))
    here, stays = (F.col("f1") == F.col("__f1")) & (F.col("f2") == F.col("__f2")), F.col("__first") & F.col("doc_id").eqNullSafe(F.col("__label"))
    again = written(beside(signed, marks, here, "inner").where(stays).groupBy("f1", "f2").count().where("count > 1").select("f1", "f2"))

    def make():
        return lambda texts: _prints(Words(texts))

    given, alias = aside(documents)
    rows = map_text(given, make, _PRINT, text=alias["text"], keep=tuple(alias.values())).withColumn("doc_id", F.col(alias["doc_id"]))
    rows = beside(rows, marks, here, "left").where(F.col("__first").isNull() | stays)
    if again.take(1):
        repeated = beside(rows, again, ["f1", "f2"], "left_semi").dropDuplicates(["f1", "f2"])
        rows = beside(rows, again, ["f1", "f2"], "left_anti").select(*alias.values()).unionByName(repeated.select(*alias.values()))
    return rows.select(*[F.col(a).alias(c) for c, a in alias.items()])


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP7_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
c AS (SELECT doc_id, w, min(doc_id) OVER (PARTITION BY w) AS copy_id FROM d WHERE len(w) > 0),
t AS (SELECT copy_id AS id, any_value(w) AS w, count(*) AS copies FROM c GROUP BY copy_id),
g AS (SELECT DISTINCT id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM t)),
n AS (SELECT id, count(*) AS n FROM g GROUP BY id),
p AS (SELECT a.id AS a, b.id AS b, count(*) AS x FROM g a JOIN g b ON a.s = b.s AND a.id <> b.id GROUP BY a.id, b.id),
e AS (SELECT p.a, p.b FROM p JOIN n na ON na.id = p.a JOIN n nb ON nb.id = p.b WHERE 9 * x >= 4 * (na.n + nb.n)),
r AS (SELECT id AS id, id AS root FROM t UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id),
m AS (SELECT id, min(root) AS class_id FROM r GROUP BY id),
l AS (SELECT e.a AS id, sum(t.copies) AS others FROM e JOIN t ON t.id = e.b GROUP BY e.a)
SELECT d.doc_id, coalesce(m.class_id, d.doc_id) AS class_id, coalesce(c.copy_id, d.doc_id) AS copy_id, CAST(CASE WHEN c.copy_id IS NULL THEN 0 ELSE t.copies - 1 + coalesce(l.others, 0) END AS BIGINT) AS n_links
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t ON t.id = c.copy_id LEFT JOIN m ON m.id = c.copy_id LEFT JOIN l ON l.id = c.copy_id
"""
