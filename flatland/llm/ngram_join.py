"""N-gram Jaccard join by a token-group matrix, to components of linked documents.

Two documents link when ``100 * |A n B| >= percent * |A u B|`` for their sets of word n-grams ("tokens").

1. A bounded sketch of token counts over all documents gives the global order, rare tokens first. Any order is exact; this one
   keeps common passages out of the prefixes. One pass writes each document's size, set hash, min-hash keys and prefix: its
   first ``n - ceil(t * n) + SHARED`` tokens. Two linked sets share at least ``SHARED`` prefix tokens.
2. Documents with equal sets are one class, held by the smallest id. From here on classes count, so thousands of copies are one.
3. Only classes with ``SHARED`` prefix tokens that other classes have, too, can link: one shuffle of (token, class), hot tokens
   apart, finds them. Their texts are fetched, once, with the blocks they go to.
4. Partition into groups: classes with a common min-hash key meet in blocks of bounded size, dealt anew for
   each key, and are linked there exactly; connected classes are a component from then on, and components whose smallest
   documents have the same min-hash are a group.
5. Token-group matrix: the union of the prefix tokens of each group, with the sizes of its members. A query's overlap
   with a group is bounded by the tokens it shares with the union; only groups that have ``SHARED`` of them from another component and
   a fitting size are opened, in blocks of bounded size, and the query is compared there with the members, exactly. Links within a
   component need no second look, which saves the square of its size without losing one between components.
6. Components that meet are joined, and spread to the copies.

Set comparisons use 64-bit token hashes recomputed from whole texts. Bound of a block: BLOCK_ROWS classes
and BLOCK_TOKENS tokens on average; larger groups have more blocks.

Disk: a text goes to several blocks. Blocks are dealt in rounds, each of about as many bytes as the candidates' texts have, however many
copies of them all blocks need. Each step's shuffle files go when its table is written, and a table when its last reader is done.

Defined cases: null, empty and white-space texts have empty sets and link with nothing; a text of fewer words than n
is one token; repeated ids are one node, linked by the texts of all its rows; a null id links with nothing and has
a null component; every row of the input gives one row.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flatland import storage
from flatland.llm.common import shuffle_partitions
from flatland.llm.components import connected_components
from flatland.llm.words import iter_words, mix, shingle_sets, shingles
from flatland.session import new_run_dir

#: Counters of the order sketch; they and nothing else of it reach the driver.
SKETCH = 1 << 16
#: Prefix tokens that two linked sets share at least (fewer if sets may be smaller).
SHARED = 4
#: Min-hash keys by which classes are first brought together.
KEYS = 3
BLOCK_ROWS = 400
BLOCK_TOKENS = 400_000


def least_size(percent: int) -> int:
    """Size of the smallest set that can link with a different one."""
    return math.ceil(percent / (100 - percent)) if percent < 100 else 1 << 62


def shared_tokens(percent: int) -> int:
    return max(1, min(SHARED, math.ceil(percent * least_size(percent) / 100))) if percent < 100 else SHARED


def prefix_size(n: int, percent: int) -> int:
    return min(n, n + (-percent * n) // 100 + shared_tokens(percent))


def _documents(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    return documents.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))


def token_counts(docs: DataFrame, size: int) -> np.ndarray:
    """Counts of all tokens of all documents, by the low bits of their hashes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SKETCH, dtype=np.int64)
        for batch in batches:
            for _, _, words in iter_words(batch.column(0)):
                hashes, _ = shingles(words, size)
                total += np.bincount((hashes & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["at", "n"])

    rows = docs.select("text").mapInArrow(count, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(SKETCH, dtype=np.int64)
    out[rows["at"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.int64)
    return out


def hot_count(counts: np.ndarray) -> int:
    """Count from which a counter's tokens are hot. Counters never count too little, so any other token has fewer rows."""
    return 4 * int(counts.mean()) + 1000


def _signature(tokens: np.ndarray, counts: np.ndarray, percent: int, from_hot: int) -> tuple[int, int, list[int], np.ndarray, np.ndarray]:
    """Two set hashes, the min-hash keys, and the prefix of a set: its hot tokens apart."""
    with np.errstate(over="ignore"):
        first = int(mix(tokens).sum(dtype=np.uint64))
        second = int(np.bitwise_xor.reduce(mix(tokens ^ np.uint64(0x5BD1E9955BD1E995))))
        keys = [int(mix(tokens ^ np.uint64(0xA24BAED4963EE407 * (k + 1) & 0xFFFFFFFFFFFFFFFF)).min()) for k in range(KEYS)]
    size = prefix_size(len(tokens), percent)
    weight = counts[(tokens & np.uint64(SKETCH - 1)).astype(np.int64)]
    if size < len(tokens):
        # All tokens of less weight than the size-th, and the smallest hashes of its own weight.
        last = np.partition(weight, size - 1)[size - 1]
        own = tokens[weight == last]
        prefix = np.concatenate((tokens[weight < last], own[:size - int((weight < last).sum())]))
    else:
        prefix = tokens
    hot = counts[(prefix & np.uint64(SKETCH - 1)).astype(np.int64)] >= from_hot
    return first, second, keys, prefix[~hot], prefix[hot]


def _signed(x) -> np.ndarray:
    return np.array(x, dtype=np.uint64).view(np.int64)


def signatures(docs: DataFrame, size: int, percent: int, counts: np.ndarray) -> DataFrame:
    """doc_id, n, h1, h2, keys, prefix and hot of every row (the last three only where another set could link)."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    least, none, from_hot = least_size(percent), np.empty(0, np.uint64), hot_count(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            for first, last, words in iter_words(batch.column(1)):
                n, h1, h2, lists = [], [], [], ([], [], [])
                for tokens in shingle_sets(words, size):
                    a, b, *own = _signature(tokens, counts, percent, from_hot) if len(tokens) else (0, 0, none, none, none)
                    n.append(len(tokens))
                    h1.append(a)
                    h2.append(b)
                    for to, x in zip(lists, own):
                        to.append(_signed(x if len(tokens) >= least else none))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, last - first), pa.array(n, pa.int64()), pa.array(_signed(h1)), pa.array(_signed(h2)),
                    *[_lists(x) for x in lists]], names=["doc_id", "n", "h1", "h2", "keys", "prefix", "hot"])

    return docs.mapInArrow(run, "doc_id long, n long, h1 long, h2 long, keys array<long>, prefix array<long>, hot array<long>")


def common_tokens(full: DataFrame, partitions: int) -> DataFrame:
    """(token, h1), each once, of the prefix tokens that classes with different sets have.

    Hot tokens are taken as common without a look. Of the others each has a bounded number of rows; they are
    dealt by token and sorted, and a run of one token with several classes is kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = h1 = np.empty(0, np.int64)

        def kept(token, h1):
            new = np.ones(len(token), dtype=bool)
            new[1:] = (token[1:] != token[:-1]) | (h1[1:] != h1[:-1])
            token, h1 = token[new], h1[new]
            same = np.zeros(len(token) + 1, dtype=bool)
            same[1:-1] = token[1:] == token[:-1]
            keep = same[1:] | same[:-1]
            return pa.RecordBatch.from_arrays([pa.array(token[keep]), pa.array(h1[keep])], names=["token", "h1"])

        for batch in batches:
            token, h1 = (np.concatenate((a, batch.column(i).to_numpy())) for i, a in enumerate((token, h1)))
            if len(token):
                done = int(np.searchsorted(token, token[-1], side="left"))     # the last token may go on
                if done:
                    yield kept(token[:done], h1[:done])
                    token, h1 = token[done:], h1[done:]
        if len(token):
            yield kept(token, h1)

    cold = full.select(F.explode("prefix").alias("token"), "h1").repartition(partitions, "token").sortWithinPartitions("token", "h1")
    hot = full.select(F.explode("hot").alias("token"), "h1").distinct()
    return cold.mapInArrow(run, "token long, h1 long").unionByName(hot)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts) if parts else np.empty(0, np.int64)))


class _Sets:
    """Sets of one block, for overlaps of one of them with all others at once."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        self._values, self._place = np.unique(np.concatenate(sets), return_inverse=True)
        self._starts = np.concatenate(([0], np.cumsum(self.sizes)))[:-1]
        self._flags = np.zeros(len(self._values) + 1, dtype=np.int64)

    def linked(self, tokens: np.ndarray, percent: int) -> np.ndarray:
        """Which sets of the block link with the set of ``tokens``."""
        at = np.searchsorted(self._values, tokens)
        at[at == len(self._values)] = 0
        at = at[self._values[at] == tokens]
        self._flags[at] = 1
        both = np.add.reduceat(self._flags[self._place], self._starts)
        self._flags[at] = 0
        return 100 * both >= percent * (len(tokens) + self.sizes - both)


def link_block(ids: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect all that is linked in a block (a spanning forest), comparing exactly."""
    block = _Sets(sets)
    root = np.full(len(ids), -1, dtype=np.int64)
    links = []
    for start in range(len(ids)):
        if root[start] >= 0:
            continue
        root[start] = start
        queue = [start]
        while queue and (root < 0).any():
            found = np.flatnonzero(block.linked(sets[queue.pop()], percent) & (root < 0))
            root[found] = start
            queue.extend(found.tolist())
            links.extend((ids[i], ids[start]) for i in found)
    return links


def open_group(members: list[tuple[int, int, np.ndarray]], queries: list[tuple[int, int, np.ndarray]], percent: int) -> list[tuple[int, int]]:
    """The two components' labels of each link found, once, by (label, id, set) of members and queries of a group."""
    block = _Sets([s for _, _, s in members])
    own = np.array([label for label, _, _ in members])
    joined: dict[int, set[int]] = {}
    links = []
    for label, _, tokens in queries:
        done = joined.setdefault(label, set())
        open_to = own < label
        if done:
            open_to &= ~np.isin(own, list(done))
        if not open_to.any():
            continue
        for i in np.flatnonzero(block.linked(tokens, percent) & open_to):
            if own[i] not in done:
                done.add(own[i])
                links.append((label, int(own[i])))
    return links


def _by_block(frame: DataFrame, size: int, solve: Callable, partitions: int, scratch: _Scratch, name: str, most: int) -> DataFrame:
    """Links of the blocks of a frame (label, doc_id, h1, bytes, text, places); a block meets in one task, one at a time.

    ``places`` has the block and kind of each copy of the text that is needed (null: of none). The copies are dealt in rounds of some ``most`` bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []

        def solved():
            links = solve(rows) if len(rows) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], names=["a", "b"])

        for batch in batches:
            blocks, kinds, labels, ids, hashes = (batch.column(i).to_pylist() for i in range(5))
            for first, last, words in iter_words(batch.column(5)):
                for i, tokens in zip(range(first, last), shingle_sets(words, size)):
                    if blocks[i] != now:
                        if rows:
                            yield solved()
                        now, rows = blocks[i], []
                    # Rows that repeat an id with another text are not of this class.
                    with np.errstate(over="ignore"):
                        own = int(_signed([mix(tokens).sum(dtype=np.uint64)])[0])
                    if own == hashes[i]:
                        rows.append((kinds[i], labels[i], ids[i], tokens))
        if rows:
            yield solved()

    placed = frame.where("places IS NOT NULL")
    rounds = max(1, math.ceil((placed.agg(F.sum(F.col("bytes") * F.size("places"))).first()[0] or 0) / max(1, most)))

    def dealt(k: int) -> DataFrame:
        own = F.filter("places", lambda place: F.pmod(place["block"], F.lit(rounds)) == k)
        return (placed.select(F.explode(own).alias("place"), "label", "doc_id", "h1", "text").select("place.block", "place.kind", "label", "doc_id", "h1", "text")
                .repartition(partitions, "block").sortWithinPartitions("block", "kind", "label", "doc_id").mapInArrow(run, "a long, b long"))

    return scratch.keep(name, *(dealt(k) for k in range(rounds)))


def _blocks_of(count: Column, tokens: Column) -> Column:
    return F.greatest(F.ceil(count / BLOCK_ROWS), F.ceil(tokens / BLOCK_TOKENS), F.lit(1)).cast("int")


#: With this setting an execution's shuffle files go when it ends, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class _Scratch:
    """Tables written to the shared folder between the steps."""

    def __init__(self, spark: SparkSession):
        self._spark, self._paths = spark, {}

    def keep(self, name: str, *frames: DataFrame) -> DataFrame:
        """The rows of the frames, written one frame after the other."""
        path = new_run_dir(self._spark, f"ngram-{name}")
        before = self._spark.conf.get(CLEANUP, None)
        self._spark.conf.set(CLEANUP, "true")
        try:
            for frame in frames:
                # A frame has the setting of the time it was made.
                frame.select("*").write.mode("append").parquet(path)
        finally:
            if before is None:
                self._spark.conf.unset(CLEANUP)
            else:
                self._spark.conf.set(CLEANUP, before)
        self._paths[name] = path
        return self._spark.read.parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            storage.delete(self._spark, self._paths.pop(name))

    def drop_all(self, but: str) -> None:
        """Delete all but the one that the result reads."""
        self.drop(*[n for n in self._paths if n != but])


def link_documents(documents: DataFrame, size: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    spark = documents.sparkSession
    scratch = _Scratch(spark)
    docs = _documents(documents, doc_id, text)
    partitions = shuffle_partitions(spark)
    signed = scratch.keep("signatures", signatures(docs, size, percent, token_counts(docs, size)))
    # What is wanted to the end, without the prefixes.
    hashes = scratch.keep("hashes", signed.select("doc_id", "n", "h1", "h2"))

    # Classes of equal sets, held by their smallest id.
    holders = hashes.where("n > 0 and doc_id is not null").groupBy("h1", "h2").agg(F.min("doc_id").alias("holder"))
    least, share = least_size(percent), shared_tokens(percent)
    labels = more = spark.createDataFrame([], "node long, component long")
    if percent < 100:
        able = signed.where("n > 0 and doc_id is not null").where(F.col("n") >= least)
        candidates, tokens = _candidates(scratch, docs, able, holders, share, partitions)
        most = candidates.agg(F.sum("bytes")).first()[0] or 0
        labels = connected_components(_group_links(scratch, candidates, size, percent, partitions, most))
        more = _matrix_links(scratch, candidates, tokens, labels, size, percent, share, partitions, most)
    # The component of each row so far; a row without words is one of its own.
    rows = hashes.join(holders.withColumnsRenamed({"h1": "a1", "h2": "a2"}),
                       (F.col("h1") == F.col("a1")) & (F.col("h2") == F.col("a2")) & (F.col("n") > 0), "left")
    rows = rows.join(labels, F.col("holder") == F.col("node"), "left").select(
        "doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "holder", "doc_id")).alias("label"))
    rows = scratch.keep("rows", rows)
    # Components that meet in the matrix, and those of rows with one id.
    met = rows.groupBy("doc_id").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select(F.col("doc_id").alias("id"), "lo")
    met = rows.join(met, F.col("doc_id") == F.col("id")).select(F.col("label").alias("a"), F.col("lo").alias("b"))
    met = met.unionByName(more.toDF("a", "b")).distinct().checkpoint()
    if not met.isEmpty():
        rows = rows.join(connected_components(met), F.col("label") == F.col("node"), "left").withColumn("label", F.coalesce("component", "label"))
    scratch.drop_all(but="rows")
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.col("label").alias("component_id"))


def _candidates(scratch: _Scratch, docs: DataFrame, full: DataFrame, holders: DataFrame, share: int, partitions: int) -> tuple[DataFrame, DataFrame]:
    """Classes that may link with another one, with texts and their blocks; and their common prefix tokens."""
    tokens = scratch.keep("tokens", common_tokens(full, partitions))
    able = scratch.keep("able", tokens.groupBy("h1").agg(F.count("*").alias("c")).where(F.col("c") >= share).select("h1"))
    # A class is read from a row of its holder; rows that repeat it say the same.
    held = holders.withColumnRenamed("holder", "doc_id").join(able, "h1", "left_semi")
    classes = scratch.keep("classes", full.select("doc_id", "h1", "h2", "n", "keys").join(held, ["doc_id", "h1", "h2"], "left_semi")
                           .drop("h2").dropDuplicates(["doc_id", "h1"]))
    scratch.drop("signatures")
    placed = classes.join(_key_blocks(classes), ["doc_id", "h1"], "left")
    candidates = docs.join(placed, "doc_id").select("doc_id", "h1", "n", F.get("keys", 0).alias("key"), "places", F.octet_length("text").cast("long").alias("bytes"), "text")
    return scratch.keep("candidates", candidates.distinct()), tokens.join(able, "h1", "left_semi")


def _key_blocks(classes: DataFrame) -> DataFrame:
    """The blocks, KEYS at most, in which a class meets those that have a min-hash key in common with it."""
    keyed = classes.select("doc_id", "h1", "n", F.posexplode("keys").alias("turn", "key"))
    sizes = (keyed.groupBy("turn", "key").agg(F.count("*").alias("rows"), F.sum("n").alias("tokens")).where("rows > 1")
             .select("turn", "key", _blocks_of(F.col("rows"), F.col("tokens")).alias("blocks")))
    block = F.xxhash64("turn", "key", F.pmod(F.xxhash64("doc_id", "h1", "turn"), F.col("blocks")))
    return (keyed.join(sizes, ["turn", "key"]).groupBy("doc_id", "h1")
            .agg(F.sort_array(F.collect_list(F.struct(block.alias("block"), F.lit(0).alias("kind")))).alias("places")))


def _group_links(scratch: _Scratch, candidates: DataFrame, size: int, percent: int, partitions: int, most: int) -> DataFrame:
    """Links found in blocks of classes that have a min-hash key in common."""

    def solve(rows):
        return link_block([r[2] for r in rows], [r[3] for r in rows], percent)

    return _by_block(candidates.withColumn("label", F.col("doc_id")), size, solve, partitions, scratch, "links", most)


def _matrix_links(scratch: _Scratch, candidates: DataFrame, tokens: DataFrame, labels: DataFrame, size: int, percent: int, share: int, partitions: int, most: int) -> DataFrame:
    """Links between components: bound each query's overlap with the groups and open those that qualify."""
    slim = candidates.select("doc_id", "h1", "n", "key").distinct().join(labels, F.col("doc_id") == F.col("node"), "left").select(
        "doc_id", "h1", "n", "key", F.coalesce("component", "doc_id").alias("label"))
    # A component goes to the group of its smallest document's min-hash, so what is alike meets in few groups, linked or not.
    place = slim.where("doc_id = label").groupBy("label").agg(F.min("key").alias("grp"))
    # Written, as are the blocks below: the steps that follow use them many times, and their plans would hold all this as often.
    groups = scratch.keep("groups", slim.join(place, "label").select("doc_id", "h1", "n", "label", "grp"))
    marked = scratch.keep("marked", tokens.join(groups, "h1"))
    scratch.drop("tokens", "able")
    # The matrix: a row for each token of a group's union, with the sizes and the smallest component of the members that have it.
    matrix = marked.groupBy("token", "grp").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    between = matrix.groupBy("token").agg(F.min("lo").alias("first"), F.max("hi").alias("last")).where("first <> last").select("token", "first")
    asked = marked.join(between, "token").where(F.col("label") > F.col("first")).select("token", "doc_id", "h1", "n", "label")
    matrix = matrix.join(between, "token", "left_semi").drop("hi").withColumnRenamed("grp", "other")
    # Two components are looked at from one side: by the members of the one with the larger label.
    bounded = (asked.join(matrix, "token")
               .where((F.col("lo") < F.col("label")) & (100 * F.col("most") >= percent * F.col("n")) & (100 * F.col("n") >= percent * F.col("least")))
               .groupBy("doc_id", "h1", "label", "other").agg(F.count("*").alias("overlap")).where(F.col("overlap") >= share))
    opened = scratch.keep("opened", bounded.select("doc_id", "h1", "label", "other"))
    scratch.drop("marked")
    shape = groups.groupBy(F.col("grp").alias("other")).agg(F.count("*").alias("rows"), F.sum("n").alias("tokens"))
    shape = scratch.keep("shape", shape.join(opened.select("other").distinct(), "other", "left_semi")
                         .select("other", _blocks_of(F.col("rows"), F.col("tokens")).alias("blocks")))
    members = (groups.join(shape, F.col("grp") == F.col("other"))
               .select("doc_id", "h1", F.lit(0).alias("kind"), "label", "other", F.pmod(F.xxhash64("doc_id", "h1"), F.col("blocks")).alias("part")))
    queries = (opened.join(shape, "other")
               .select("doc_id", "h1", F.lit(1).alias("kind"), "label", "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1).cast("array<long>")).alias("part")))
    # Where very many ask for one block, they are dealt over copies of it.
    wide = scratch.keep("wide", queries.groupBy("other", "part").agg(F.ceil(F.count("*") / (4 * BLOCK_ROWS)).cast("int").alias("turns")))
    queries = queries.join(wide, ["other", "part"]).withColumn("turn", F.pmod(F.xxhash64("doc_id", "h1"), F.col("turns"))).drop("turns")
    members = members.join(wide, ["other", "part"]).withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1).cast("array<long>"))).drop("turns")
    places = (members.unionByName(queries).groupBy("doc_id", "h1", "label")
              .agg(F.collect_list(F.struct(F.xxhash64("other", "part", "turn").alias("block"), "kind")).alias("places")))
    frame = scratch.keep("asked", places.join(candidates.select("doc_id", "h1", "bytes", "text"), ["doc_id", "h1"]))
    scratch.drop("candidates")

    def solve(rows):
        members, queries = ([r[1:] for r in rows if r[0] == kind] for kind in (0, 1))
        return open_group(members, queries, percent) if members and queries else []

    return _by_block(frame, size, solve, partitions, scratch, "more", most)
