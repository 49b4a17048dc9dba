"""N-gram Jaccard self-join by T-occurrence search, and its components.

A text's set holds the hashes of its distinct shingles: of three words for the digest
(op1), of five for the pipeline's stage (``keep_one``).  Texts of equal sets form a
class, and only one of each class is searched.  t, the least similarity, is a pair of
integers: 9/10 for the digest, 4/5 for the stage.

A set of n shingles shares at least need(n) = ceil(t n) with any similar one, so it can
be left out as soon as too many of its shingles stand in no other set.  Two rounds of
counting do that, both exact:

* Heads.  Of each set only the least hashes go out, n - need(n) + margin(n) of them; two
  similar sets have at least margin(need(n)) of these in common.  Sets with fewer shared
  ones are out.  Texts that merely share a passage, a licence line or frequent words go here.
* Whole sets of those left.  A set stays if need(n) of its shingles are shared.  Its
  n - need(n) + 1 rarest shingles, those in no other set first, must hold one that a
  similar set has among its own rarest; the shared ones of these are its short lists.

What is counted moves packed, 32 bits of a shingle's hash within one of many buckets that
grow with the data: two shingles with equal bits may only let a set stay that could go.
Sets that meet in a short list are gathered into clusters (no pairs are written), and
only sets of clusters with two members or more are searched.

Within a cluster each set is searched in an inverted index by DivideSkip: the lists
of its shingles are divided by length, the short ones merged by counting, and the
candidates with enough occurrences there are looked up by binary search in the long
ones; those that reach the overlap (intersection >= t * union, in integers) are links.
A cluster with more than ``BLOCK_TOKENS`` shingles is dealt into blocks and the search
runs for each pair of blocks, so a group of copies with a third of all rows is never in one task.  A task gives each set its number of links and one edge to
a tree of its finds, so what leaves it grows with the sets, not with the pairs.

Defined cases: null, empty and blank texts have no set (n_shingles 0), are linked with
nothing and are their own component; repeated rows are linked; a null doc_id never
names a component that has another (a component of null ids only is null); very long
texts are a block of their own; an empty table gives an empty result; extra columns
are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import SPACE, pick, small_batches, staged
from shelfcast.llm.components import components

SHINGLE, SHARE = 3, (9, 10)            # words of a shingle and least similarity of the digest
NEAR_SHINGLE, NEAR_SHARE = 5, (4, 5)   # and of the stage that keeps one of near copies
MARGIN = 10                # a head has one in so many of its set's shingles beyond those that may differ
BUCKET = 1 << 20           # shingles compared in one task
LEAST_BUCKETS = 48
FILTER_BITS = 1 << 25      # of the filter of texts to read again: 4 MB at any size of the data
BLOCK_TOKENS = 500_000     # shingles of the sets in one block
MU = 1.0                   # DivideSkip: long lists = T / (MU * log2(longest) + 1)
KEY = ["no_id", "doc_id", "th"]


def _mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(dict):
    """64-bit hash of a word, kept for the next time."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 100_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingle_set(text: str | None, words: Words, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    if not isinstance(text, str):
        return np.zeros(0, dtype=np.uint64)
    # bytes: lower() changes A-Z only, split() is on [\x20\x09-\x0D]
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter((words[w] for w in parts), dtype=np.uint64, count=len(parts))
    n = min(shingle, len(h))
    out = np.full(len(h) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        out = _mix(out + np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - n + 1 + i])
    return np.unique(out)


def set_key(s: np.ndarray) -> tuple[int, int]:
    """128 bits that don't depend on the order."""
    return (int(_mix(s).sum(dtype=np.uint64).view(np.int64)),
            int(_mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)))


def need(n: int, share: tuple[int, int] = SHARE) -> int:
    """Least overlap with any set that is similar enough and not larger: ceil(t n)."""
    return -(-share[0] * n // share[1])


def margin(n: int) -> int:
    return max(1, n // MARGIN)


def head(s: np.ndarray, share: tuple[int, int] = SHARE) -> np.ndarray:
    """The least hashes of a set; similar sets have ``margin`` of the smaller one's need in common there."""
    return s[:len(s) - need(len(s), share) + margin(len(s))]


def _texts(docs: DataFrame) -> DataFrame:
    return pick(docs, "doc_id", "text").select(
        F.col("doc_id").isNull().cast("int").alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), "text")


def _batch(number: int) -> int:
    """A name for the ``number``-th batch of this task."""
    return (TaskContext.get().partitionId() << 32) + number


def signatures(texts: DataFrame, shingle: int = SHINGLE, share: tuple[int, int] = SHARE) -> DataFrame:
    """no_id, doc_id, th, n, s1, s2, the head, and where the row stands: batch, idx."""
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words()
        for k, b in enumerate(batches):
            sets = [shingle_set(t, words, shingle) for t in b["text"]]
            out = pd.DataFrame([(len(s), *set_key(s)) for s in sets], columns=["n", "s1", "s2"])
            once = ~out.duplicated()                          # of a batch's equal sets one head is enough
            heads = [head(s, share).view(np.int64) if go and len(s) else np.zeros(0, np.int64) for s, go in zip(sets, once)]
            yield pd.concat([b[KEY].reset_index(drop=True), out], axis=1).assign(
                head=pd.Series(heads, dtype=object), batch=_batch(k), idx=np.arange(len(b)))

    return texts.mapInPandas(sign, "no_id int, doc_id long, th long, n long, s1 long, s2 long, head array<long>, batch long, idx int")


def _asked(sets: DataFrame, column: str, buckets: int, tagged: bool) -> DataFrame:
    """The shingles of ``column``, packed: one row for each bucket and batch."""
    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for batch, part in b.groupby("batch", sort=False):
                n = [len(x) for x in part[column]]
                if not sum(n):
                    continue
                m = _mix(np.concatenate(part[column].tolist()).astype(np.int64).view(np.uint64))
                bucket = ((m >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
                by = np.argsort(bucket, kind="stable")
                cut = np.flatnonzero(np.diff(bucket[by], prepend=-1))
                ends = np.append(cut[1:], len(by))
                packed = {"keys": m.astype(np.uint32)[by], "idx": np.repeat(part["idx"].to_numpy(), n).astype(np.uint16)[by]}
                if tagged:
                    packed["tags"] = np.repeat(part["s1"].to_numpy(), n).astype(np.uint32)[by]
                out = {c: [x[i:j].tobytes() for i, j in zip(cut, ends)] for c, x in packed.items()}
                yield pd.DataFrame({"bucket": bucket[by[cut]], "batch": batch, "tags": [b""] * len(cut)} | out)

    return sets.mapInPandas(deal, "bucket long, batch long, keys binary, idx binary, tags binary")


def _answer(b: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: the shingles that stand in two different sets or more, and in how many (255 at most)."""
    n = [len(x) // 4 for x in b["keys"]]
    keys, idx = (np.frombuffer(b"".join(b[c]), dtype=t) for c, t in (("keys", np.uint32), ("idx", np.uint16)))
    tags = np.frombuffer(b"".join(b["tags"]), dtype=np.uint32)
    by = np.lexsort((tags, keys)) if len(tags) else np.argsort(keys, kind="stable")
    new = np.diff(keys[by].astype(np.int64), prepend=-1) != 0
    other = new | (np.diff(tags[by].astype(np.int64), prepend=-1) != 0) if len(tags) else np.ones(len(by), dtype=bool)
    df = np.empty(len(by), dtype=np.int64)
    df[by] = np.add.reduceat(other.astype(np.int64), np.flatnonzero(new))[np.cumsum(new) - 1]
    shared = df > 1
    ends = np.cumsum(np.bincount(np.repeat(np.arange(len(n)), n)[shared], minlength=len(n)))
    packed = {"keys": keys[shared], "idx": idx[shared], "df": np.minimum(df[shared], 255).astype(np.uint8)}
    out = pd.DataFrame({"batch": b["batch"].to_numpy(), "bucket": b["bucket"].to_numpy()} | {
        c: [x[i:j].tobytes() for i, j in zip(np.append(0, ends[:-1]), ends)] for c, x in packed.items()})
    return out[np.diff(ends, prepend=0) > 0]


def shared_shingles(sets: DataFrame, column: str, tagged: bool) -> DataFrame:
    """batch, bucket and, packed, keys, idx, df of the shingles of ``column`` that two sets have.

    ``sets`` names each row by batch and idx.  ``tagged``: some rows hold equal sets (told apart by s1)."""
    total = sets.agg(F.sum(F.size(column))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-total // BUCKET))
    return _asked(sets, column, buckets, tagged).groupBy("bucket").applyInPandas(
        _answer, "batch long, bucket long, keys binary, idx binary, df binary")


def _counted(b: pd.DataFrame) -> pd.DataFrame:
    """How many shared shingles each row of one batch has."""
    n = np.bincount(np.frombuffer(b"".join(b["idx"]), dtype=np.uint16))
    at = np.flatnonzero(n)
    return pd.DataFrame({"batch": b["batch"].iloc[0], "idx": at.astype(np.int32), "shared": n[at].astype(np.int64)})


def promising(rows: DataFrame, share: tuple[int, int] = SHARE) -> DataFrame:
    """n, s1, s2 of the sets whose heads share enough with others'."""
    heads = shared_shingles(rows.where(F.size("head") > 0).select("batch", "idx", "s1", "head"), "head", True)
    counted = heads.select("batch", "idx").groupBy("batch").applyInPandas(_counted, "batch long, idx int, shared long")
    fit = F.expr(f"({share[0]} * n + {share[1] - 1}) DIV {share[1]}")               # need(n)
    least = F.greatest(F.lit(1), F.expr("f DIV " + str(MARGIN)))
    return (rows.select("batch", "idx", "n", "s1", "s2").join(counted, ["batch", "idx"])
            .withColumn("f", fit).where(F.col("shared") >= least).select("n", "s1", "s2").distinct())


def _filter(keys: DataFrame) -> np.ndarray:
    """Bit table of the text hashes ``th``: of fixed size, whatever the number of rows."""
    at = F.pmod("th", F.lit(FILTER_BITS)) + 1                  # Spark numbers bits from 1
    parts = (keys.groupBy(F.bitmap_bucket_number(at).alias("part"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect())
    table = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for r in parts:                                            # 4096 bytes a part
        at = (r["part"] - 1) * 4096
        table[at:at + 4096] = np.frombuffer(r["bits"], dtype=np.uint8)
    return table


def filled(texts: DataFrame, reps: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """node, n, copies, tokens, batch, idx of ``reps`` (node, n, copies and a row's KEY), one row each.

    A text that the filter can't rule out is cut into shingles again; the join decides.  Of
    repeated rows one is kept before anything meets."""
    table = texts.sparkSession.sparkContext.broadcast(_filter(reps))

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, bits = Words(), table.value
        for b in batches:
            at = b["th"].to_numpy() % FILTER_BITS
            b = b[(bits[at // 8] >> (at % 8) & 1).astype(bool)].drop_duplicates(KEY)
            tokens = [shingle_set(t, words, shingle).view(np.int64) for t in b["text"]]
            yield b[KEY].assign(tokens=pd.Series(tokens, index=b.index, dtype=object))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for k, b in enumerate(batches):
            yield b.assign(batch=_batch(k), idx=np.arange(len(b)))

    cut = texts.mapInPandas(fill, "no_id int, doc_id long, th long, tokens array<long>")
    return (cut.groupBy(*KEY).agg(F.first("tokens").alias("tokens")).join(reps.hint("merge"), KEY)
            .select("node", "n", "copies", "tokens")
            .mapInPandas(place, "node long, n long, copies long, tokens array<long>, batch long, idx int"))


def short_lists(sets: DataFrame, share: tuple[int, int] = SHARE) -> DataFrame:
    """node, key: the shared ones of each set's rarest shingles, if enough of the set is shared."""
    def pick_rarest(names: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
        if not len(shared):
            return pd.DataFrame({"node": [], "key": []})
        n = [len(x) for x in shared["df"]]
        idx, df = (np.frombuffer(b"".join(shared[c]), dtype=t) for c, t in (("idx", np.uint16), ("df", np.uint8)))
        key = np.repeat(shared["bucket"].to_numpy(), n) * (1 << 32) + np.frombuffer(b"".join(shared["keys"]), dtype=np.uint32)
        by = np.lexsort((key, df, idx))
        idx, key = idx[by], key[by]
        at = names["idx"].to_numpy()
        lo, hi = np.searchsorted(idx, at), np.searchsorted(idx, at, side="right")
        size = names["n"].to_numpy()
        most = size - np.array([need(int(x), share) for x in size]) + 1 - (size - (hi - lo))     # behind the unshared
        node = names["node"].to_numpy()
        short = [(np.full(m, v), key[a:a + m]) for v, a, m in zip(node, lo, most) if m > 0]
        return pd.DataFrame({"node": np.concatenate([x[0] for x in short] or [[]]).astype(np.int64),
                             "key": np.concatenate([x[1] for x in short] or [[]]).astype(np.int64)})

    return (sets.select("batch", "idx", "node", "n").groupBy("batch")
            .cogroup(shared_shingles(sets, "tokens", False).groupBy("batch"))
            .applyInPandas(pick_rarest, "node long, key long"))


def _find(root: np.ndarray, i: int) -> int:
    while root[i] != i:
        root[i] = root[root[i]]
        i = root[i]
    return i


def search(sizes: np.ndarray, sets: list[np.ndarray], index: np.ndarray, query: np.ndarray,
           share: tuple[int, int] = SHARE) -> Iterator[tuple[int, np.ndarray]]:
    """T-occurrence search: (set, the linked sets before it in order of size).

    ``index`` and ``query`` say which sets are indexed and which are looked up."""
    num, den = share
    order = np.argsort(sizes, kind="stable")
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    ordered = sizes[order]
    # inverted index: for each shingle, the ranks (by size) of the sets that have it
    tokens = np.concatenate([sets[i] for i in order if index[i]] or [np.zeros(0, np.int64)])
    ranks = np.repeat(place[[i for i in order if index[i]]], [len(sets[i]) for i in order if index[i]])
    by = np.argsort(tokens, kind="stable")
    tokens, ranks = tokens[by], ranks[by]
    keys, starts = np.unique(tokens, return_index=True)
    ends = np.append(starts[1:], len(tokens))
    if not len(keys):
        return
    for rank, i in enumerate(order):
        if not query[i]:
            continue
        n, t = int(sizes[i]), need(int(sizes[i]), share)
        low = int(np.searchsorted(ordered, t))              # smaller sets can't be similar enough
        if low >= rank:
            continue
        at = np.minimum(np.searchsorted(keys, sets[i]), len(keys) - 1)
        at = at[keys[at] == sets[i]]
        lo, hi = starts[at], ends[at]
        if len(at) < t:
            continue
        lengths = hi - lo
        by_len = np.argsort(lengths, kind="stable")
        lo, hi, lengths = lo[by_len], hi[by_len], lengths[by_len]
        n_long = min(int(t / (MU * np.log2(max(2, lengths[-1])) + 1)), t - 1)
        short = len(lo) - n_long
        merged = np.concatenate([ranks[a:b] for a, b in zip(lo[:short], hi[:short])])
        merged = merged[(merged >= low) & (merged < rank)]
        if len(merged) < t - n_long:
            continue
        count = np.bincount(merged - low, minlength=rank - low)
        left = n_long
        cand = np.flatnonzero(count >= t - left)
        have = count[cand]
        for a, b in zip(lo[short:], hi[short:]):            # binary search in the long lists, shortest first
            if not len(cand):
                break
            run = ranks[a:b]
            where = np.minimum(np.searchsorted(run, cand + low), len(run) - 1)
            have = have + (run[where] == cand + low)
            left -= 1
            enough = have >= t - left
            cand, have = cand[enough], have[enough]
        linked = cand[(num + den) * have >= num * (n + ordered[cand + low])] + low
        if len(linked):
            yield int(i), order[linked]


def _group(b: pd.DataFrame, share: tuple[int, int] = SHARE) -> pd.DataFrame:
    """Links of one group: (node, n_links, root) for each set, root a linked set or itself."""
    b = b.drop_duplicates(["node"]).reset_index(drop=True)
    first, second = int(b["block_a"].iloc[0]), int(b["block_b"].iloc[0])
    sets = [np.asarray(x, dtype=np.int64) for x in b["tokens"]]
    own = b["block"].to_numpy()
    sizes, copies = b["n"].to_numpy(), b["copies"].to_numpy()
    links, root = np.zeros(len(b), dtype=np.int64), np.arange(len(b))

    def tie(i: int, found: np.ndarray) -> None:
        links[i] += copies[found].sum()
        links[found] += copies[i]
        for x in {_find(root, int(j)) for j in found}:
            top = _find(root, i)
            root[max(top, x)] = min(top, x)

    if first == second:
        every = np.ones(len(b), dtype=bool)
        for i, found in search(sizes, sets, every, every, share):
            tie(i, found)
    else:                                                   # each block is looked up in the other
        for a in (first, second):
            for i, found in search(sizes, sets, own == a, own != a, share):
                tie(i, found)
    node = b["node"].to_numpy()
    return pd.DataFrame({"node": node, "links": links, "root": node[[_find(root, i) for i in range(len(b))]]})


def jaccard_join(docs: DataFrame, block_tokens: int = BLOCK_TOKENS, shingle: int = SHINGLE,
                 share: tuple[int, int] = SHARE) -> DataFrame:
    """no_id, doc_id, th, n_shingles, component_id, n_links, kept: one row for each row of ``docs``.

    Linked are sets of shingles of ``shingle`` words with a similarity of at least share[0] / share[1].
    ``kept`` marks the row that stands for its component (of repeated rows, all)."""
    small_batches(docs.sparkSession)
    texts = _texts(docs)
    rows = staged(signatures(texts, shingle, share), "jaccard-rows")
    of_set = ["n", "s1", "s2"]
    classes = staged(
        rows.where("n > 0").groupBy(*of_set).agg(
            F.min(F.struct(*KEY)).alias("rep"), F.count(F.lit(1)).alias("copies"))
        .select(F.monotonically_increasing_id().alias("node"), *of_set, "rep", "copies"), "jaccard-classes")
    left = staged(classes.join(promising(rows, share), of_set).select("node", "n", "copies", "rep.*"), "jaccard-left")
    sets = staged(filled(texts, left, shingle), "jaccard-sets")
    # clusters: sets with a shingle of their short lists in common
    short = staged(short_lists(sets, share), "jaccard-short")
    least = short.groupBy("key").agg(F.min("node").alias("hub"))
    tied = short.join(least, "key").where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    clusters = components(tied)
    members = staged(sets.select("node", "n").join(clusters, "node").withColumnRenamed("root", "cluster"), "jaccard-members")
    # small clusters share a group of about block_tokens shingles; large ones are dealt into blocks
    sizes = members.groupBy("cluster").agg(F.sum("n").alias("tokens"))
    small = sizes.where(F.col("tokens") <= block_tokens).agg(F.sum("tokens")).first()[0] or 0
    bins = max(1, -(-2 * small // block_tokens))
    large = F.col("tokens") > block_tokens
    sizes = sizes.select(
        "cluster", F.when(large, F.col("cluster")).otherwise(-1 - F.pmod(F.xxhash64("cluster"), F.lit(bins))).alias("grp"),
        F.when(large, F.ceil(F.col("tokens") / block_tokens)).otherwise(1).cast("int").alias("blocks"))
    dealt = members.join(sizes, "cluster").select(
        "node", "grp", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"))
    gathered = sets.select("node", "n", "copies", "tokens").join(dealt, "node")
    paired = gathered.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "node", "n", "copies", "grp", "block", F.least("block", "other").alias("block_a"),
        F.greatest("block", "other").alias("block_b"), "tokens")
    found = staged(paired.groupBy("grp", "block_a", "block_b").applyInPandas(
        lambda b: _group(b, share), "node long, links long, root long"), "jaccard-links")
    linked = components(found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    # one row per class: the least row of its component, and the links of each of its copies
    of_node = classes.select("node", *of_set, "rep", "copies").join(links, "node", "left").join(linked, "node", "left")
    of_node = of_node.withColumn("root", F.coalesce("root", "node"))
    best = of_node.groupBy("root").agg(F.min("rep").alias("best"))
    judged = of_node.join(best, "root").select(
        *of_set, "best", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    with_set = rows.where("n > 0").join(judged, of_set)
    name = F.when(F.col("best.no_id") == 0, F.col("best.doc_id"))
    own = F.when(F.col("no_id") == 0, F.col("doc_id"))
    return with_set.select(
        *KEY, F.col("n").alias("n_shingles"), name.alias("component_id"), "n_links",
        (F.struct(*KEY) == F.col("best")).alias("kept")
    ).unionByName(rows.where("n = 0").select(
        *KEY, F.col("n").alias("n_shingles"), own.alias("component_id"), F.lit(0).cast("long").alias("n_links"),
        F.lit(True).alias("kept")))


def join_documents(docs: DataFrame) -> DataFrame:
    """The digest: doc_id, n_shingles, component_id, n_links."""
    return jaccard_join(docs).select(
        F.when(F.col("no_id") == 0, F.col("doc_id")).alias("doc_id"), "n_shingles", "component_id", "n_links")


def keep_one(docs: DataFrame, shingle: int = NEAR_SHINGLE, share: tuple[int, int] = NEAR_SHARE) -> DataFrame:
    """One row of each component of ``docs``, and all rows without words; columns as they are."""
    blank = F.translate(F.coalesce("text", F.lit("")), SPACE, "") == ""
    kept = (jaccard_join(docs, shingle=shingle, share=share).where("kept AND n_shingles > 0")
            .select(*[F.col(k).alias(f"__{k}") for k in KEY]).distinct())
    keyed = docs.where(~blank).withColumns({
        "__no_id": F.col("doc_id").isNull().cast("int"), "__doc_id": F.coalesce("doc_id", F.lit(0)),
        "__th": F.xxhash64("text")})
    keys = [f"__{k}" for k in KEY]
    return keyed.join(kept, keys, "left_semi").dropDuplicates(keys).drop(*keys).unionByName(docs.where(blank))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE
        WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, CAST(len(g) AS BIGINT) AS n FROM s),
t AS (SELECT doc_id, unnest(g) AS g FROM s),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM t x JOIN t y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 90 * (na.n + nb.n - k)),
r AS (SELECT doc_id, doc_id AS seen FROM n UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.seen),
m AS (SELECT doc_id, min(seen) AS component_id FROM r GROUP BY doc_id),
d AS (SELECT a, count(*) AS k FROM e GROUP BY a)
SELECT n.doc_id, n.n AS n_shingles, m.component_id, coalesce(d.k, 0) AS n_links
FROM n JOIN m ON m.doc_id = n.doc_id LEFT JOIN d ON d.a = n.doc_id
"""
