"""N-gram Jaccard join by several global token orders.

A token is the 64-bit hash of a word shingle. Under any order that all documents share, two sets
of Jaccard similarity ``t`` have a token in common among their first ``n - ceil(t n) + 1`` ones,
and ``k`` tokens among ``k - 1`` more. Two orders are used. The first sorts tokens by how often
they occur: the most frequent tokens of the corpus are counted one by one, the others by buckets
of a table of fixed size, so tokens that many documents hold come last and hardly ever lead to
candidates. The second does not follow the counts: it is the order of another hash, with the
frequent tokens last. A candidate must share prefix tokens under the first order, at positions
that leave enough tokens for the similarity, and an eighth of a set's tokens, which is several,
under the second; only then the whole sets are compared.

Documents with equal sets are one class from the start, and links are searched between classes.
Short posting lists form all their pairs. In a long one, which is mostly a group of similar
documents, not every pair is formed: all are first compared with two of its members. Afterwards
only its pairs in different components are left, and these are compared in full, so no link
between components is lost. ``near_links`` compares every pair of every list instead.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger.llm.common import Recent, fresh, named, whole
from storeledger.staging import materialise

_BUCKET_BITS = 20  # a table of 1 M counts: 4 MB, whatever the input
_FREQUENT = 1 << 18  # tokens counted one by one: 4 MB, whatever the input
_FREQUENT_OF_TASK = 1 << 14  # of which a task names so many
_SLICES = 64
_CACHED_WORDS = 250_000
_SHORT_LIST = 32  # posting lists up to this length form all their pairs at once
_FILTER_BITS = 24  # bit table of candidate documents: 2 MB
# --- Fixed values: odd multipliers that mix hashes ---
_MIX = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64
)


class Shingler:
    """Hashes of the word shingles of texts."""

    def __init__(self, width: int):
        import xxhash

        self.width, self.known = width, Recent(xxhash.xxh64_intdigest, _CACHED_WORDS)

    def hashes(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all texts one after the other, and the text each belongs to."""
        # bytes: only A to Z are lower-cased, only ASCII blanks separate words
        split = [t.encode("utf-8", "surrogatepass").lower().split() if t else [] for t in texts]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        short = (counts > 0) & (counts < self.width)
        # a shorter text is one shingle of all its words: filled up with a mark no word can be
        filled = [
            w if not s else w + [b" "] * (self.width - len(w))
            for w, s in zip(split, short.tolist(), strict=True)
        ]
        counts[short] = self.width
        flat = np.fromiter(
            map(self.known.__getitem__, chain.from_iterable(filled)), np.uint64, int(counts.sum())
        )
        owner = np.repeat(np.arange(len(texts)), counts)
        size = len(flat) - self.width + 1
        if size <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        mixed = np.zeros(size, np.uint64)
        for i in range(self.width):
            mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX[i % 4] + flat[i : i + size]
        mixed ^= mixed >> np.uint64(32)
        mixed *= _MIX[1]
        mixed ^= mixed >> np.uint64(29)
        inside = owner[:size] == owner[self.width - 1 :]
        return mixed[inside], owner[:size][inside]

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        """The distinct hashes of each text, sorted."""
        hashes, owner = self.hashes(texts)
        ends = np.searchsorted(owner, np.arange(len(texts) + 1))
        return [np.unique(hashes[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes * _MIX[1]) >> np.uint64(64 - _BUCKET_BITS)


def _parts(column: pa.Array, size: int = 128) -> Iterator[tuple[int, list]]:
    for at in range(0, len(column), size):
        yield at, column.slice(at, size).to_pylist()


@dataclass(frozen=True)
class Counts:
    """What the orders follow: counts of buckets, and of the most frequent tokens (sorted)."""

    buckets: np.ndarray
    tokens: np.ndarray
    uses: np.ndarray

    def of(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of tokens, and which of them are frequent ones."""
        fill = self.buckets[_bucket(tokens)].astype(np.int64)
        if not len(self.tokens):
            return fill, np.zeros(len(tokens), bool)
        place = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        known = self.tokens[place] == tokens
        # a frequent token comes behind all others, which only share its bucket's count
        return np.where(known, self.uses[place] + (1 << 40), fill), known


def _token_counts(texts: DataFrame, width: int) -> Counts:
    """One pass over all texts.

    A task keeps the counts of all buckets, and of tokens the most frequent ones: after every
    million tokens only twice as many as it may name go on. What reaches the driver is one
    table of buckets and the ``_FREQUENT`` tokens with the largest sums over the tasks. The
    counts only order tokens, the same for all documents, so an inexact one costs no result.
    """
    buckets = 1 << _BUCKET_BITS
    step = buckets // _SLICES

    def packed(number: int, part: np.ndarray) -> pa.RecordBatch:
        # the order needs no exact count beyond the largest of 32 bits
        data = np.minimum(part, np.iinfo(np.int32).max).astype(np.int32).tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int32()), pa.array([zlib.compress(data, 1)], pa.binary()),
             pa.array([None], pa.int64()), pa.array([None], pa.int64())],
            names=["slice", "counts", "token", "uses"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, counts, seen = Shingler(width), np.zeros(buckets, np.int64), False
        waiting: list[np.ndarray] = []
        tokens, uses = np.empty(0, np.uint64), np.empty(0, np.int64)

        def added() -> tuple[np.ndarray, np.ndarray]:
            new = np.concatenate(waiting)
            np.add(counts, np.bincount(_bucket(new).astype(np.int32), minlength=buckets),
                   out=counts)
            # only tokens whose bucket is full enough can be among the most frequent
            full = np.partition(counts, -_FREQUENT_OF_TASK)[-_FREQUENT_OF_TASK]
            new = new[counts[_bucket(new)] >= max(full, 2)]
            found, own = np.unique(new, return_counts=True)
            both, place = np.unique(np.concatenate([tokens, found]), return_inverse=True)
            total = np.bincount(place, np.concatenate([uses, own])).astype(np.int64)
            if len(both) > 2 * _FREQUENT_OF_TASK:
                best = np.argpartition(total, -2 * _FREQUENT_OF_TASK)[-2 * _FREQUENT_OF_TASK :]
                best.sort()
                both, total = both[best], total[best]
            return both, total

        for batch in batches:
            for _, texts in _parts(batch.column(0), 512):
                hashes, seen = shingler.hashes(texts)[0], True
                waiting.append(hashes)
                if sum(map(len, waiting)) > 1 << 20:
                    tokens, uses = added()
                    waiting = []
        if waiting:
            tokens, uses = added()
        if seen:
            for s in range(_SLICES):
                yield packed(s, counts[s * step : (s + 1) * step])
            best = np.argsort(-uses, kind="stable")[:_FREQUENT_OF_TASK]
            best = best[uses[best] > 1]
            nothing = pa.nulls(len(best), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(best), -1, np.int32)), nothing,
                 pa.array(tokens[best].view(np.int64)), pa.array(uses[best])],
                names=["slice", "counts", "token", "uses"],
            )

    def add(
        key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]
    ) -> Iterator[pa.RecordBatch]:
        total = np.zeros(step, np.int64)
        for batch in batches:
            for part in batch.column("counts"):
                total += np.frombuffer(zlib.decompress(part.as_py()), np.int32)
        yield packed(key[0].as_py(), total).select(["slice", "counts"])

    sums = materialise(
        texts.select("text").mapInArrow(count, "slice int, counts binary, token long, uses long"),
        "near-counts",
    )
    table = np.zeros(buckets, np.int32)
    of_buckets = sums.where("slice >= 0").select("slice", "counts")
    for row in of_buckets.groupBy("slice").applyInArrow(  # _SLICES rows
        add, "slice int, counts binary"
    ).collect():
        table[row["slice"] * step : (row["slice"] + 1) * step] = np.frombuffer(
            zlib.decompress(row["counts"]), np.int32
        )
    frequent = (
        sums.where("slice < 0").groupBy("token").agg(F.sum("uses").alias("uses"))
        .orderBy(F.desc("uses"), "token").limit(_FREQUENT).toArrow()
    )
    tokens = frequent.column("token").to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return Counts(table, tokens[order], frequent.column("uses").to_numpy()[order])


def _leading(tokens: np.ndarray, first: np.ndarray, length: int, *more: np.ndarray) -> np.ndarray:
    """The first ``length`` tokens in order of ``first``, ties by ``more`` and the token."""
    near = np.arange(len(tokens))
    if 0 < length < len(tokens):
        edge = np.partition(first, length - 1)[length - 1]
        near = np.flatnonzero(first <= edge)
    keys = [tokens[near], *(m[near] for m in reversed(more)), first[near]]
    return tokens[near[np.lexsort(keys)]][:length]


def _prefixes(texts: DataFrame, counts: Counts, width: int, percent: int) -> DataFrame:
    """Per document: size and signature of its set, and its prefixes under both orders.

    The second prefix is kept as 32-bit hashes; ``need`` says how many of it a similar document
    shares, less the tokens of this one whose hashes are equal.
    """
    shared = texts.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, known = Shingler(width), shared.value
        for batch in batches:
            doc, text, said = batch.columns
            for at, texts in _parts(text):
                sizes, marks, firsts, seconds, needs = [], [], [], [], []
                for tokens in shingler.sets(texts):
                    n = len(tokens)
                    spare = n - (percent * n + 99) // 100  # tokens a similar set may lack
                    several = min(n - spare, 1 + n // 8) if n else 0
                    fill, frequent = known.of(tokens)
                    first = _leading(tokens, fill, spare + 1 if n else 0)
                    mixed = (tokens * _MIX[2]) >> np.uint64(1)
                    second = _leading(
                        tokens, mixed + (frequent.astype(np.uint64) << np.uint64(63)),
                        spare + several,
                    )
                    short = np.unique((second * _MIX[3] >> np.uint64(32)).astype(np.uint32))
                    sizes.append(n)
                    marks.append(tokens.tobytes())
                    firsts.append(first.view(np.int64))
                    seconds.append(short.view(np.int32))
                    needs.append(several - (len(second) - len(short)))
                yield pa.RecordBatch.from_arrays(
                    [
                        doc.slice(at, 128), said.slice(at, 128), pa.array(sizes, pa.int64()),
                        pa.array([_digest(m) for m in marks], pa.binary()),
                        pa.array(firsts, pa.list_(pa.int64())),
                        pa.array(seconds, pa.list_(pa.int32())), pa.array(needs, pa.int32()),
                    ],
                    names=["doc", "said", "n", "mark", "first", "second", "need"],
                )

    return texts.mapInArrow(
        run,
        "doc long, said string, n long, mark binary, first array<long>, second array<int>,"
        " need int",
    )


def _digest(data: bytes) -> bytes:
    import hashlib

    return hashlib.blake2b(data, digest_size=16).digest()


def _flag(ids: np.ndarray) -> np.ndarray:
    return (ids.astype(np.uint64) * _MIX[0]) >> np.uint64(64 - _FILTER_BITS)


def _candidate_sets(texts: DataFrame, candidates: DataFrame, width: int) -> DataFrame:
    """The whole sets of candidate documents, with their signatures (and of a few others)."""
    places = 1 << _FILTER_BITS

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(places, np.bool_)
        for batch in batches:
            bits[_flag(batch.column(0).to_numpy())] = True
        if bits.any():
            packed = np.packbits(bits).tobytes()
            size = len(packed) // _SLICES
            for s in range(_SLICES):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([s], pa.int32()),
                        pa.array([packed[s * size : (s + 1) * size]], pa.binary()),
                    ],
                    names=["slice", "bits"],
                )

    def merge(
        key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]
    ) -> Iterator[pa.RecordBatch]:
        merged = np.zeros(places // 8 // _SLICES, np.uint8)
        for batch in batches:
            for part in batch.column("bits"):
                merged |= np.frombuffer(part.as_py(), np.uint8)
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int32()), pa.array([merged.tobytes()], pa.binary())],
            names=["slice", "bits"],
        )

    schema = "slice int, bits binary"
    found = candidates.mapInArrow(mark, schema).groupBy("slice").applyInArrow(merge, schema)
    bits = np.zeros((_SLICES, places // 8 // _SLICES), np.uint8)
    for row in found.collect():  # _SLICES rows
        bits[row["slice"]] = np.frombuffer(row["bits"], np.uint8)
    shared = texts.sparkSession.sparkContext.broadcast(bits.reshape(-1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, flags = Shingler(width), np.unpackbits(shared.value).view(np.bool_)
        for batch in batches:
            doc, text = batch.columns
            chosen = np.flatnonzero(flags[_flag(doc.to_numpy())])
            for at in range(0, len(chosen), 128):
                own = pa.array(chosen[at : at + 128])
                sets = [s.view(np.int64) for s in shingler.sets(text.take(own).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        doc.take(own), pa.array([_digest(s.tobytes()) for s in sets]),
                        pa.array(sets, pa.list_(pa.int64())),
                    ],
                    names=["doc", "mark", "tokens"],
                )

    return texts.mapInArrow(run, "doc long, mark binary, tokens array<long>")


def components(links: DataFrame) -> DataFrame:
    """``doc, root``: the smallest node reachable by ``links (a, b)`` from each linked node.

    Roots take over the smallest root beside them and paths are shortened until nothing
    changes; every round is a table, so a lost executor costs one round at most.
    """
    both = materialise(
        links.select("a", "b").union(links.select("b", "a")).distinct(), "cc-links"
    )
    roots = materialise(
        both.groupBy(F.col("a").alias("doc")).agg(F.least(F.min("b"), F.col("doc")).alias("root")),
        "cc-roots",
    )
    while True:
        mine = roots.select(F.col("doc").alias("a"), F.col("root").alias("of_a"))
        theirs = roots.select(F.col("doc").alias("b"), F.col("root").alias("of_b"))
        # a root hears of the smallest root beside its members
        heard = (
            both.join(mine, "a").join(theirs, "b").where(F.col("of_b") < F.col("of_a"))
            .groupBy(F.col("of_a").alias("old")).agg(F.min("of_b").alias("new"))
        )
        heard = materialise(heard, "cc-heard")
        if heard.isEmpty():
            return roots
        moved = roots.join(heard, F.col("root") == F.col("old"), "left").select(
            "doc", F.coalesce("new", "root").alias("root")
        )
        moved = materialise(moved, "cc-moved")
        jump = moved.select(F.col("doc").alias("old"), F.col("root").alias("new"))
        shorter = moved.join(jump, F.col("root") == F.col("old"), "left").select(
            "doc", F.coalesce("new", "root").alias("root")
        )
        roots = materialise(shorter, "cc-roots")


def _enough(na: Column, nb: Column, percent: int) -> Column:
    """Tokens that two sets of these sizes must share."""
    return F.ceil((na + nb) * percent / (100 + percent) - 1e-9)


def _side(postings: DataFrame, name: str, *more: str) -> DataFrame:
    """Postings as one side of a pair."""
    return postings.select(
        "token", F.col("doc").alias(name), F.col("n").cast("long").alias(f"n_{name}"),
        F.col("place").alias(f"place_{name}"), *[F.col(c).alias(f"{c}_{name}") for c in more],
    )


def _near_pairs(x: DataFrame, y: DataFrame, percent: int, which: Column) -> DataFrame:
    """Pairs ``a < b`` of the same lists that may be similar, by their sizes and by the tokens
    that come after the shared one. (The first token a similar pair shares passes, so a pair is
    never lost by a later one that does not.)"""
    left = F.least(F.col("n_x") - F.col("place_x"), F.col("n_y") - F.col("place_y"))
    fits = 100 * F.least("n_x", "n_y") >= percent * F.greatest("n_x", "n_y")
    enough = left >= _enough(F.col("n_x"), F.col("n_y"), percent)
    return (
        x.join(y, "token").where(which & fits & enough)
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    )


def _second_order(pairs: DataFrame, seconds: DataFrame) -> DataFrame:
    """Pairs that share enough prefix tokens under the second order too."""
    side_a = seconds.select(F.col("doc").alias("a"), F.col("second").alias("second_a"),
                            F.col("need").alias("need_a"))
    side_b = seconds.select(F.col("doc").alias("b"), F.col("second").alias("second_b"),
                            F.col("need").alias("need_b"))
    both = pairs.join(side_a, "a").join(side_b, "b")
    shared = F.size(F.array_intersect("second_a", "second_b"))
    passed = both.where(
        F.arrays_overlap("second_a", "second_b") & (shared >= F.least("need_a", "need_b"))
    ).select("a", "b")
    return materialise(passed, "near-candidates")


def _compared(
    pairs: DataFrame, sets: DataFrame, marks: DataFrame, percent: int
) -> DataFrame:
    """Pairs whose whole sets are similar, with the tokens they share and have.

    ``marks`` has the signature of each node, by which ``sets`` are found.
    """
    def side(name: str) -> DataFrame:
        return marks.select(F.col("doc").alias(name), F.col("mark").alias(f"mark_{name}"))

    marked = pairs.join(side("a"), "a").join(side("b"), "b")
    set_a = sets.select(F.col("mark").alias("mark_a"), F.col("tokens").alias("tokens_a"))
    set_b = sets.select(F.col("mark").alias("mark_b"), F.col("tokens").alias("tokens_b"))
    both = marked.join(set_a, "mark_a").join(set_b, "mark_b")
    shared = F.size(F.array_intersect("tokens_a", "tokens_b"))
    counted = both.select(
        "a", "b", shared.alias("shared"),
        (F.size("tokens_a") + F.size("tokens_b")).alias("sizes"),
    )
    union = F.col("sizes") - F.col("shared")
    return counted.where(F.col("shared") * 100 >= union * percent).select(
        "a", "b", "shared", union.alias("all_tokens")
    ).distinct()  # a set may be there twice


def _verified(
    pairs: DataFrame, sets: DataFrame, marks: DataFrame, percent: int
) -> DataFrame:
    return _compared(pairs, sets, marks, percent).select("a", "b")


def _rooted(rows: DataFrame, roots: DataFrame, column: str, name: str) -> DataFrame:
    known = roots.select(F.col("doc").alias("known"), F.col("root").alias("known_root"))
    return rows.join(known, F.col(column) == F.col("known"), "left").withColumn(
        name, F.coalesce("known_root", column)
    ).drop("known", "known_root")


@dataclass(frozen=True)
class _Classes:
    """Documents, and their classes of equal sets as the nodes of the join.

    ``found``: a row per document with ``doc, said`` (a hash of its text), ``n, mark``.
    ``classes``: ``mark, node, rep`` (the smallest id). ``reps``: ``doc`` (the node), ``n, first,
    second, need``. ``postings``: ``doc, n, place, token, rows`` of tokens in two classes or more.
    """

    texts: DataFrame
    found: DataFrame
    classes: DataFrame
    reps: DataFrame
    postings: DataFrame
    width: int
    percent: int

    def seconds(self) -> DataFrame:
        return self.reps.select("doc", "second", "need")

    def marks(self) -> DataFrame:
        return self.classes.select(F.col("node").alias("doc"), "mark")

    def sets(self, nodes: DataFrame) -> DataFrame:
        """``mark, tokens`` of nodes (and of a few other documents), as written."""
        own = self.classes.join(nodes.select(F.col("doc").alias("node")), "node", "left_semi")
        known = self.texts.where(F.col("doc").isNotNull()).select("doc", "text")
        ids = materialise(own.select(F.col("rep").alias("doc")).distinct(), "near-candidate-ids")
        return materialise(
            _candidate_sets(known, ids, self.width).select("mark", "tokens"), "near-sets"
        )


def _classed(
    docs: DataFrame, width: int, percent: int, id_column: str, text_column: str
) -> _Classes:
    text = named(text_column).cast("string")
    texts = docs.select(named(id_column).cast("long").alias("doc"), text.alias("text"))
    counts = _token_counts(texts, width)
    prepared = texts.select("doc", "text", F.md5(F.col("text").cast("binary")).alias("said"))
    found = materialise(_prefixes(prepared, counts, width, percent), "near-prefixes")
    filled = found.where((F.col("n") > 0) & F.col("doc").isNotNull())
    classes = materialise(
        filled.groupBy("mark").agg(F.min("doc").alias("rep"))
        .withColumn("node", F.monotonically_increasing_id()),
        "near-classes",
    )
    reps = found.join(classes, "mark").where(F.col("doc") == F.col("rep"))
    reps = materialise(
        reps.dropDuplicates(["node"]).select(
            F.col("node").alias("doc"), "n", "first", "second", "need"
        ),
        "near-reps",
    )
    postings = reps.select(
        "doc", F.col("n").cast("int").alias("n"), F.posexplode("first").alias("place", "token")
    )
    # lists with a single class lead nowhere
    lists = postings.groupBy("token").agg(F.count("*").alias("rows")).where("rows > 1")
    postings = postings.join(materialise(lists, "near-lists"), "token")
    postings = materialise(postings, "near-postings")
    return _Classes(texts, found, classes, reps, postings, width, percent)


def _component_links(known: _Classes) -> DataFrame:
    """Links that hold the components together, between nodes."""
    percent, seconds = known.percent, known.seconds()
    short = known.postings.where(F.col("rows") <= _SHORT_LIST)
    long = known.postings.where(F.col("rows") > _SHORT_LIST)

    # every pair of a short list, and each document of a long one with two of its members: the
    # one with the fewest rarer tokens, and any other
    spot = F.struct("place", "doc", "n")
    pivots = long.groupBy("token").agg(
        F.min(spot).alias("first"),
        F.min(F.struct(F.xxhash64("doc").alias("any"), spot.alias("spot")))["spot"].alias("other"),
    )
    pivots = pivots.select("token", F.explode(F.array("first", "other")).alias("y"))
    near = _near_pairs(_side(short, "x"), _side(short, "y"), percent, F.col("x") < F.col("y"))
    near = near.unionByName(
        _near_pairs(
            _side(long, "x"),
            materialise(_side(pivots.select("token", "y.*"), "y"), "near-pivots"),
            percent, F.col("x") != F.col("y"),
        )
    )
    candidates = _second_order(near.distinct(), seconds)
    nodes = candidates.select(F.explode(F.array("a", "b")).alias("doc")).unionByName(
        long.select("doc")
    )
    sets = known.sets(materialise(nodes.distinct(), "near-nodes"))
    links = materialise(_verified(candidates, sets, known.marks(), percent), "near-links")
    roots = components(links)

    # the rest of the long lists: pairs whose documents are in different components still
    rooted = materialise(_rooted(long, roots, "doc", "root"), "near-rooted")
    main = (
        rooted.groupBy("token", "root").agg(F.count("*").alias("members"))
        .groupBy("token")
        .agg(F.count("*").alias("roots"), F.max(F.struct("members", "root"))["root"].alias("main"))
        .where("roots > 1")
    )
    split = materialise(
        rooted.join(materialise(main.select("token", "main"), "near-split"), "token"), "near-open"
    )
    # two documents outside the main component meet once
    apart = (F.col("root_x") != F.col("root_y")) & (
        (F.col("root_y") == F.col("main_y")) | (F.col("x") < F.col("y"))
    )
    outside = split.where(F.col("root") != F.col("main"))
    rest = _near_pairs(
        _side(outside, "x", "root"), _side(split, "y", "root", "main"), percent, apart
    )
    rest = _second_order(rest.distinct(), seconds)
    more = materialise(_verified(rest, sets, known.marks(), percent), "near-links")
    return links.unionByName(more)


def _with_components(known: _Classes, by_id: bool) -> DataFrame:
    """``found`` with ``component``, the smallest id of the classes linked with a row's class
    (null without words); ``by_id``: rows that share an id are linked too."""
    links = _component_links(known)
    if by_id:
        # of an id with several sets, each is linked with the first: none where ids are unique
        several = (
            known.found.where((F.col("n") > 0) & F.col("doc").isNotNull())
            .groupBy("doc").agg(F.min("mark").alias("one"), F.max("mark").alias("other"))
            .where(F.col("one") != F.col("other")).select("doc", "one")
        )
        number = known.classes.select("mark", "node")
        shared = known.found.join(materialise(several, "near-repeated"), "doc").select(
            "mark", "one"
        ).distinct().join(number, "mark").select("one", F.col("node").alias("b")).join(
            number.withColumnRenamed("mark", "one"), "one"
        ).select(F.col("node").alias("a"), "b").where("a <> b")
        links = links.unionByName(shared)
    roots = components(links)
    rooted = _rooted(known.classes, roots, "node", "root")
    smallest = rooted.groupBy("root").agg(F.min("rep").alias("component"))
    rooted = rooted.join(materialise(smallest, "near-smallest"), "root").select(
        "mark", "component"
    )
    return known.found.join(materialise(rooted, "near-components"), "mark", "left").select(
        "doc", "said", "n", "component"
    )


def near_components(
    docs: DataFrame,
    *,
    width: int = 5,
    percent: int = 80,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Components of documents linked by a Jaccard similarity of at least ``percent / 100``.

    A document's set holds its distinct shingles of ``width`` words (text without ASCII blanks,
    A to Z lower-cased); with fewer words it is the whole sequence. Returns ``doc_id, n_shingles,
    component_id`` (smallest id reachable by links), one row per row of ``docs``. A document
    without words (null and empty texts) links with nothing and is its own component. Rows that
    repeat an id are each compared by their own set, and are linked by the id. A row with a null
    id belongs to the component of the documents with its set, or to none (null), and links no
    others. An empty table gives no rows.
    """
    known = _classed(docs, width, percent, id_column, text_column)
    return _with_components(known, by_id=True).select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.coalesce("component", "doc")).otherwise(F.col("doc"))
        .alias("component_id"),
    )


def near_links(
    docs: DataFrame,
    *,
    width: int = 5,
    percent: int = 80,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """The join itself: all links between classes of equal sets, and the members of the classes.

    Returns ``a, b, shared, all_tokens`` with ``a < b``, one row per pair of classes whose
    similarity ``shared / all_tokens`` reaches ``percent / 100``, and ``doc_id, class_id``, one
    row per document with an id and with words. Every pair of every posting list passes the two
    orders and is verified, so no link is lost; a group of n similar, different texts has
    n (n - 1) / 2 links, and they are all there. ``near_components`` does not need them.
    """
    known = _classed(docs, width, percent, id_column, text_column)
    sides = _side(known.postings, "x"), _side(known.postings, "y")
    near = _near_pairs(*sides, percent, F.col("x") < F.col("y")).distinct()
    candidates = _second_order(near, known.seconds())
    nodes = candidates.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
    sets = known.sets(materialise(nodes, "near-nodes"))
    members = known.found.where(F.col("doc").isNotNull()).join(
        known.classes.select("mark", "node"), "mark"
    )
    return (
        _compared(candidates, sets, known.marks(), percent),
        members.select(F.col("doc").alias("doc_id"), F.col("node").alias("class_id")),
    )


def link_counts(links: DataFrame, members: DataFrame) -> DataFrame:
    """``doc_id, class_id, n_links``: how many other documents each one is linked with, those
    with an equal set included, from ``near_links``. No pair of documents is formed."""
    sizes = members.groupBy("class_id").agg(F.count("*").alias("size"))
    sizes = materialise(sizes, "class-sizes")
    ends = links.select(F.explode(F.array(
        F.struct(F.col("a").alias("class_id"), F.col("b").alias("other")),
        F.struct(F.col("b").alias("class_id"), F.col("a").alias("other")),
    )).alias("end")).select("end.*")
    beside = ends.join(sizes.toDF("other", "others"), "other").groupBy("class_id").agg(
        F.sum("others").alias("linked")
    )
    counts = sizes.join(beside, "class_id", "left").select(
        "class_id", (F.coalesce("linked", F.lit(0)) + F.col("size") - 1).alias("n_links")
    )
    return members.join(materialise(counts, "class-links"), "class_id").select(
        "doc_id", "class_id", "n_links"
    )


def keep_one(
    docs: DataFrame,
    *,
    width: int = 5,
    percent: int = 80,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``docs`` with the smallest id of each group of linked sets, all columns kept.

    Rows are decided on by their own text: of rows that repeat an id with other texts, only those
    go whose set is linked with a document of a smaller id. Rows without an id stay, and so do
    rows without words and rows that repeat the kept id and its set.
    """
    known = _classed(docs, width, percent, id_column, text_column)
    names = [fresh(docs, "near_gone"), fresh(docs, "near_said")]
    found = _with_components(known, by_id=False)
    dropped = found.where(F.col("component") < F.col("doc")).select("doc", "said").distinct()
    dropped = materialise(dropped.toDF(*names), "near-dropped")
    said = F.md5(named(text_column).cast("string").cast("binary"))
    same = (named(id_column).cast("long") == F.col(names[0])) & (said == F.col(names[1]))
    return docs.join(dropped, same, "left_anti")
