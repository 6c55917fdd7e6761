"""MinHash near-duplicates with sequential Bayesian verification.

A document is the set of its distinct word shingles, as 64-bit hashes. Equal
sets (by a 128-bit digest) are one class from the start and are never compared.
``BANDS`` bands of ``ROWS`` minima each propose candidates: a pair at the least
similarity of 0.85 shares no band with a probability of 3e-7.

Candidates of a bucket are compared in batches of ``STEP`` minima. After each batch
a pair goes where the posterior probability (uniform prior) that it is similar
enough, given the matches so far, is below ``MISS``. What a bucket hands on is a
spanning forest of the pairs that survive, not the pairs. A bucket of over
``BUCKET`` classes hands on links to its smallest class unchecked, summed up by
the exchange alone; it is checked later.

Survivors are verified on their full sets. Classes that survivors connect form
a coarse group; a group is dealt into chunks of at most ``CHUNK`` shingles by a
hash of the class, and the task of a chunk finds a spanning forest of its exact
links. Where a group has several chunks, rounds follow: classes outside the
group's largest component so far become pivots, a bounded number in each round,
and are compared exactly with every class of all chunks, each chunk in a task of its
own, until no class outside the largest component is left that was no pivot. So
every link between different components has been looked at, whatever the size
of a group, and no task holds more than a chunk or the pivots.

Defined cases: NULL and empty texts and texts of blanks have no shingles and
are linked with nothing; fewer words than a shingle are one shingle; NULL
numbers never name a component unless it has no other (then it is NULL and its
documents are kept); rows that share a number are told apart by their text;
repeated rows keep one row each; other columns are ignored, whatever their
names; an empty table gives no rows.
"""

import hashlib
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowtally.llm.common import cut, words_of
from flowtally.llm.simhash import components

SHINGLE = 3
PERCENT = 85
BANDS, ROWS, STEP = 32, 6, 32
MISS = 1e-7
BUCKET = 4096
CHUNK = 4_000_000
PIVOTS = 64

_RANDOM = np.random.default_rng(20240115)
_FACTORS = _RANDOM.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_SHIFTS = _RANDOM.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_BAND_SEEDS = _RANDOM.integers(0, 1 << 63, BANDS, dtype=np.uint64)
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mix(a, b):
    """One 64-bit hash of two."""
    x = a * _M1 + b
    x ^= x >> np.uint64(32)
    x *= _M2
    return x ^ x >> np.uint64(29)


class _Words(dict):
    """Word (bytes) -> 64-bit hash, bounded."""

    def __missing__(self, word):
        if len(self) > 500_000:
            self.clear()
        code = xxhash.xxh64_intdigest(word, 42)
        if len(word) <= 100:
            self[word] = code
        return code


_words = _Words()


def forget_words():
    """Frees the hashes of words that this worker holds."""
    _words.clear()


def shingles(text, size=SHINGLE):
    """Distinct shingles of a whole text as sorted hashes."""
    words = words_of(text)
    codes = np.fromiter(map(_words.__getitem__, words), dtype=np.uint64, count=len(words))
    if not len(codes):
        return codes
    # The number of words is part of a short text's hash, so it equals no shingle.
    width = min(size, len(codes))
    out = np.full(len(codes) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        out = mix(out, codes[k:len(codes) - width + 1 + k])
    return np.unique(out)


def signature(codes):
    """Minima of a set under ``BANDS * ROWS`` permutations of 32 bits."""
    low = np.full(len(_FACTORS), 0xFFFFFFFF, dtype=np.uint32)
    short = (codes >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 1024):
        np.minimum(low, (short[at:at + 1024, None] * _FACTORS + _SHIFTS).min(axis=0), out=low)
    return low


def _band_keys(minima):
    keys = _BAND_SEEDS.copy()
    parts = minima.reshape(BANDS, ROWS).astype(np.uint64)
    for k in range(ROWS):
        keys = mix(keys, parts[:, k])
    return keys.view(np.int64)


def least_matches(percent=PERCENT, miss=MISS):
    """After each batch of minima the matches that a pair needs to stay.

    Of n minima m match. With a uniform prior the similarity is distributed as
    Beta(m + 1, n - m + 1), and the chance that it is at least t equals that of
    at most m successes in n + 1 trials of probability t.
    """
    t, needed = percent / 100, []
    for n in range(STEP, BANDS * ROWS + 1, STEP):
        chance, m = (1 - t) ** (n + 1), 0
        while chance < miss:
            m += 1
            chance += comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
        needed.append(m)
    return needed


def row_hash():
    """A hash that names a row, together with its doc_id, the same wherever it is worked out."""
    return F.xxhash64("doc_id", "text")


def prints(docs, size=SHINGLE):
    """doc_id, row, n (size of the set), d1 and d2 (digest), minima (their low bytes) and keys of the bands."""
    def run(batches):
        for batch in batches:
            texts = batch.column(2)
            sets = [shingles(texts[i].as_py(), size) for i in range(batch.num_rows)]
            minima = [signature(s) for s in sets]
            digests = np.array([np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), dtype=np.int64)
                                for s in sets]).reshape(-1, 2)
            keys = np.concatenate([_band_keys(m) for m in minima]) if minima else np.zeros(0, dtype=np.int64)
            ends = np.arange(0, len(keys) + 1, BANDS, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(digests[:, 0]), pa.array(digests[:, 1]),
                 pa.array([m.astype(np.uint8).tobytes() for m in minima], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(keys))],
                names=["doc_id", "row", "n", "d1", "d2", "minima", "keys"])

    return docs.select("doc_id", row_hash().alias("row"), "text").mapInArrow(
        run, "doc_id long, row long, n long, d1 long, d2 long, minima binary, keys array<long>")


def _groups(batches, keys):
    """Rows sorted by their first ``keys`` columns -> tables of whole groups, some at a time; none is split."""
    kept = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if kept is None else pa.concat_tables([kept, rows])
        places = np.stack([rows.column(k).to_numpy() for k in range(keys)], axis=1)
        last = len(places) - int(np.argmax((places[::-1] != places[-1]).any(axis=1))) \
            if (places != places[-1]).any() else 0
        kept = rows.slice(last)
        if last:
            yield rows.slice(0, last), _starts(places[:last])
    if kept is not None:
        places = np.stack([kept.column(k).to_numpy() for k in range(keys)], axis=1)
        yield kept, _starts(places)


def _starts(places):
    changes = np.flatnonzero((places[1:] != places[:-1]).any(axis=1)) + 1
    return np.concatenate([[0], changes, [len(places)]])


def _edges(links):
    a, b = zip(*links) if links else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _survivors(minima, needed):
    """Links (places) that span the pairs of a bucket which no batch of minima rules out."""
    waiting, links = np.arange(len(minima)), []
    while len(waiting):
        reached, waiting = [waiting[0]], waiting[1:]
        while reached and len(waiting):
            at = reached.pop()
            alive, matches = np.arange(len(waiting)), 0
            for step, least in enumerate(needed):
                part = slice(step * STEP, (step + 1) * STEP)
                equal = (minima[waiting[alive], part] == minima[at, part]).sum(axis=1)
                matches = equal if step == 0 else matches + equal
                keep = matches >= least
                alive, matches = alive[keep], matches[keep]
            links += [(at, x) for x in waiting[alive]]
            reached += waiting[alive].tolist()
            waiting = np.delete(waiting, alive)
    return links


def _bucket_links(percent, miss):
    needed = least_matches(percent, miss)

    def run(batches):
        for rows, starts in _groups(batches, 1):
            nodes = rows.column("node").to_numpy()
            minima = np.frombuffer(b"".join(rows.column("minima").to_pylist()), dtype=np.uint8)
            minima = minima.reshape(len(nodes), BANDS * ROWS)
            links = []
            for a, b in zip(starts[:-1], starts[1:]):
                links += [(nodes[a + x], nodes[a + y]) for x, y in _survivors(minima[a:b], needed)]
            yield _edges(links)

    return run


def _candidates(classes, percent, miss, bucket):
    """Links between classes whose closure holds that of all pairs similar enough."""
    banded = classes.where("n > 0").select("node", F.explode("keys").alias("key"))
    buckets = banded.groupBy("key").agg(F.count("*").alias("members"), F.min("node").alias("low")).where("members > 1")
    met = cut(banded.join(buckets, "key"), "buckets")
    large = met.where(F.col("members") > bucket).where("node > low").select(F.col("node").alias("a"), F.col("low").alias("b"))
    small = met.where(F.col("members") <= bucket).select("key", "node").join(classes.select("node", "minima"), "node")
    checked = small.select("key", "node", "minima").repartition("key").sortWithinPartitions("key", "node").mapInArrow(
        _bucket_links(percent, miss), "a long, b long")
    return large.unionByName(checked).distinct()


def _similar(mine, other, percent):
    if 100 * min(len(mine), len(other)) < percent * max(len(mine), len(other)):
        return False
    both = len(np.intersect1d(mine, other, assume_unique=True))
    return 100 * both >= percent * (len(mine) + len(other) - both)


def _exact_forest(sets, percent):
    """Links (places) that span the exactly similar pairs of some sets."""
    links, todo = [], np.arange(len(sets))
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    sizes = np.array([len(s) for s in sets])
    ends = np.cumsum(sizes)
    parts = [ids[b - n:b] for b, n in zip(ends, sizes)]
    mark = np.zeros(int(ids.max()) + 1, dtype=bool)

    def packed(places):
        """The sets of some places in one array, with their starts."""
        starts = np.concatenate([[0], np.cumsum(sizes[places])[:-1]])
        return places, np.concatenate([parts[p] for p in places]), starts

    while len(todo):
        reached, todo = [todo[0]], todo[1:]
        pack = packed(todo) if len(todo) else None
        while reached and len(todo):
            at = reached.pop()
            if 2 * len(todo) < len(pack[0]):
                pack = packed(todo)
            mark[parts[at]] = True
            both = np.add.reduceat(mark[pack[1]].astype(np.int64), pack[2])
            mark[parts[at]] = False
            near = 100 * both >= percent * (sizes[pack[0]] + sizes[at] - both)
            found = np.intersect1d(pack[0][near], todo, assume_unique=True)
            links += [(at, x) for x in found]
            reached += found.tolist()
            todo = np.setdiff1d(todo, found, assume_unique=True)
    return links


def _verify(size, percent):
    """Exact links of whole chunks: rows (root, chunk, node, d1, d2, text), sorted."""
    def run(batches):
        for rows, starts in _groups(batches, 2):
            nodes, links = rows.column("node").to_numpy(), []
            texts = rows.column("text")
            for a, b in zip(starts[:-1], starts[1:]):
                places, sets = [], []
                for i in range(a, b):
                    # A class that came twice, by a row that was there twice, counts once.
                    if not places or nodes[places[-1]] != nodes[i]:
                        places.append(i)
                        sets.append(shingles(texts[i].as_py(), size))
                if len(sets) > 1:
                    links += [(nodes[places[x]], nodes[places[y]]) for x, y in _exact_forest(sets, percent)]
            yield _edges(links)

    return run


def _compare(size, percent):
    """Exact links of members with the pivots of their group: rows (root, chunk, member, node, text), sorted."""
    def run(batches):
        place, pivots = None, {}
        for batch in batches:
            links, texts = [], batch.column("text")
            columns = [batch.column(k).to_pylist() for k in range(4)]
            for i, (root, chunk, member, node) in enumerate(zip(*columns)):
                if (root, chunk) != place:
                    place, pivots = (root, chunk), {}
                mine = shingles(texts[i].as_py(), size)
                if not member:
                    pivots[node] = mine
                else:
                    links += [(node, p) for p, other in pivots.items() if p != node and _similar(mine, other, percent)]
            yield _edges(links)

    return run


def _across_chunks(texts, edges, size, percent, pivots):
    """The exact links and those between chunks of one group; ``texts`` holds the groups of several chunks."""
    if texts.isEmpty():
        return edges
    done = None
    while True:
        named = components(edges)
        members = texts.select("root", "node").join(named.withColumnRenamed("root", "part"), "node", "left")
        members = cut(members.select("root", "node", F.coalesce("part", "node").alias("part")), "members")
        parts = members.groupBy("root", "part").agg(F.count("*").alias("members"))
        largest = parts.groupBy("root").agg(F.max(F.struct("members", "part")).alias("most"))
        rest = members.join(largest, "root").where(F.col("part") != F.col("most.part")).select("root", "node")
        if done is not None:
            rest = rest.join(done, "node", "left_anti")
        turn = F.row_number().over(Window.partitionBy("root").orderBy("node"))
        chosen = cut(rest.withColumn("turn", turn).where(F.col("turn") <= pivots).select("node"), "pivots")
        if chosen.isEmpty():
            return edges
        with_pivots = texts.join(chosen, "node").select(
            "root", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)).alias("chunk"),
            F.lit(False).alias("member"), "node", "text")
        others = texts.join(chosen.join(texts, "node").select("root").distinct(), "root", "left_semi").select(
            "root", "chunk", F.lit(True).alias("member"), "node", "text")
        order = ["root", "chunk", "member", "node"]
        found = with_pivots.unionByName(others).repartition("root", "chunk").sortWithinPartitions(*order).mapInArrow(
            _compare(size, percent), "a long, b long")
        edges = cut(edges.unionByName(found), "links")
        done = cut(chosen if done is None else done.unionByName(chosen), "done")


def links(docs, classes, percent=PERCENT, size=SHINGLE, miss=MISS, bucket=BUCKET, chunk=CHUNK, pivots=PIVOTS):
    """Exact links (a, b) between classes whose closure is that of all pairs similar enough."""
    coarse = components(_candidates(classes, percent, miss, bucket))
    return exact_links(docs, classes, coarse, percent, size, chunk, pivots)


def exact_links(docs, classes, coarse, percent, size, chunk=CHUNK, pivots=PIVOTS):
    """Exact links (a, b) between the classes of each coarse group (node, root), whose closure is that of all such links.

    ``classes`` has node, n and the row that stands for the class: row and from_doc.
    """
    groups = cut(coarse.unionByName(coarse.select(F.col("root").alias("node"), "root").distinct()), "groups")
    sized = groups.join(classes.select("node", "row", "from_doc", "n"), "node")
    chunks = sized.groupBy("root").agg(F.ceil(F.sum("n") / F.lit(chunk)).alias("chunks"))
    members = sized.join(chunks, "root").select(
        "root", "chunks", F.pmod(F.xxhash64("node"), "chunks").alias("chunk"), "node", "row", "from_doc")
    same_row = (F.col("of_row") == F.col("row")) & F.col("doc_id").eqNullSafe(F.col("from_doc"))
    texts = (docs.select("doc_id", row_hash().alias("of_row"), "text").join(members, same_row)
             .select("root", "chunks", "chunk", "node", "text"))
    texts = cut(texts, "group-texts")
    order = ["root", "chunk", "node"]
    exact = texts.select(*order, "text").repartition("root", "chunk").sortWithinPartitions(*order).mapInArrow(
        _verify(size, percent), "a long, b long")
    several = texts.where("chunks > 1").dropDuplicates(["node"])
    return _across_chunks(several, cut(exact, "links"), size, percent, pivots)


def near_duplicates(docs, percent=PERCENT, size=SHINGLE, **bounds):
    """doc_id, n_shingles, component_id (smallest doc_id reachable) and kept of every document.

    ``bounds`` are the parameters of :func:`links`; results do not depend on
    them, but for ``miss``, the accepted chance to lose a pair.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    printed = cut(prints(docs, size), "prints")
    classes = printed.where("n > 0").groupBy("d1", "d2", "n").agg(
        F.min("doc_id").alias("first"), F.min(F.struct("row", F.col("doc_id").alias("from_doc"), "minima", "keys")).alias("one"))
    classes = cut(classes.select("d1", "d2", "n", "first", "one.*", F.monotonically_increasing_id().alias("node")), "classes")
    roots = components(links(docs, classes, percent, size, **bounds))
    named = classes.select("node", "d1", "d2", "first").join(roots, "node", "left").select(
        "d1", "d2", "first", F.coalesce("root", "node").alias("root"))
    named = cut(named, "components")
    lowest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(lowest, "root").select("d1", "d2", "component_id")
    some = printed.where("n > 0").select("doc_id", "n", "d1", "d2").join(named, ["d1", "d2"]).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id")
    none = printed.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return some.unionByName(none).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
