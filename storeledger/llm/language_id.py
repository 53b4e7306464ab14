"""Language ID by unigram pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. The probability
of a word is the sum over all ways to cut it into pieces, which a forward pass adds up without
listing them; a text is the product of its words. Piece probabilities come from a few rounds of
expectation maximisation on a bounded sample of labelled documents: every task adds up expected
piece counts over its words, Spark adds up the tasks, and the driver divides.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeledger.llm.common import fresh, named
from storeledger.staging import materialise

UNKNOWN = "und"
_LETTERS = re.compile(r"[^\W\d_]+")
_LONGEST = 40  # a longer run of letters is scored in parts of this length
_UNKNOWN_CHARACTER = 1e-7
_CACHED = 400_000


def public_pieces(name: str = "piece_bpe_32k.model") -> list[str]:
    """The lower-case pieces of a public vocabulary; a leading mark stands for a word start."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
    pieces = (
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    )
    return sorted({p for p in pieces if p == p.lower()})


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case, long ones in parts."""
    words = _LETTERS.findall(text.lower())
    if max(map(len, words), default=0) <= _LONGEST:
        return words
    return [w[i : i + _LONGEST] for w in words for i in range(0, len(w), _LONGEST)]


@dataclass
class Pieces:
    """Piece probabilities, one column per language, with a last row for unknown characters."""

    index: dict[str, int]
    probability: np.ndarray
    longest: int

    def edges(self, words: list[str]) -> Iterator[tuple[int, int, np.ndarray]]:
        """For words of one length: (from, to, row per word; -1 where there is no piece)."""
        marked = ["▁" + w for w in words]
        size, unknown = len(marked[0]), len(self.index)
        for i in range(size):
            for j in range(i + 1, min(size, i + self.longest) + 1):
                rows = [self.index.get(w[i:j], -1) for w in marked]
                if j == i + 1:
                    rows = [unknown if r < 0 else r for r in rows]
                if max(rows) >= 0:
                    yield i, j, np.array(rows)

    def _values(self, rows: np.ndarray) -> np.ndarray:
        values = self.probability[rows]
        values[rows < 0] = 0.0
        return values

    def forward(self, edges: list, count: int, size: int) -> np.ndarray:
        """Sum over the segmentations of each prefix: (position, word, language)."""
        sums = np.zeros((size + 1, count, self.probability.shape[1]))
        sums[0] = 1.0
        for i, j, rows in edges:  # in order of i: all that ends at i is there
            sums[j] += sums[i] * self._values(rows)
        return sums

    def score(self, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language."""
        scores = np.empty((len(words), self.probability.shape[1]))
        by_size: dict[int, list[int]] = {}
        for n, word in enumerate(words):
            by_size.setdefault(len(word), []).append(n)
        for size, places in by_size.items():
            edges = self.edges([words[n] for n in places])
            scores[places] = np.log(self.forward(edges, len(places), size + 1)[size + 1])
        return scores

    def expected(self, words: list[str], weight: np.ndarray) -> np.ndarray:
        """Expected piece counts over words with a weight per language."""
        counts = np.zeros_like(self.probability)
        by_size: dict[int, list[int]] = {}
        for n, word in enumerate(words):
            by_size.setdefault(len(word), []).append(n)
        for size, places in by_size.items():
            edges = list(self.edges([words[n] for n in places]))
            ahead = self.forward(edges, len(places), size + 1)
            behind = np.zeros_like(ahead)
            behind[size + 1] = weight[places] / ahead[size + 1]
            for i, j, rows in reversed(edges):
                values = self._values(rows)
                behind[i] += values * behind[j]
                np.add.at(counts, rows, ahead[i] * values * behind[j])
        return counts


@dataclass
class LanguageModel:
    languages: list[str]
    pieces: Pieces


def train(
    docs: DataFrame,
    pieces: list[str] | None = None,
    *,
    sample: int = 400,
    rounds: int = 2,
    text_column: str = "text",
    lang_column: str = "lang",
) -> LanguageModel:
    """Learn piece probabilities from the rows with a language.

    At most ``sample`` different texts per language are used, each once and as a whole: those
    with the smallest hashes, so copies of a text neither raise its weight nor the number. Rows
    without text or language teach nothing. Without any labelled row the model knows no
    language; an empty table has none.
    """
    labelled = docs.select(
        named(lang_column).cast("string").alias("lang"), named(text_column).alias("text")
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    labelled = labelled.withColumn("place", F.xxhash64("text"))
    # one row per language
    counts = {r["lang"]: r["texts"] for r in
              labelled.select("lang", "place").distinct().groupBy("lang")
              .agg(F.count("*").alias("texts")).collect()}
    languages = sorted(counts)
    pieces = public_pieces() if pieces is None else sorted(set(pieces))
    model = Pieces(
        {p: n for n, p in enumerate(pieces)},
        np.full((len(pieces) + 1, max(1, len(languages))), 1.0 / (len(pieces) + 1)),
        max(map(len, pieces)),
    )
    model.probability[-1] = _UNKNOWN_CHARACTER
    if not languages:
        return LanguageModel([], model)

    number = F.create_map(*[F.lit(x) for n, lang in enumerate(languages) for x in (lang, n)])
    # twice as many as wanted by a share of the hashes, then exactly the smallest ones
    rate = F.create_map(
        *[F.lit(x) for lang in languages for x in (lang, min(1.0, 2 * sample / counts[lang]))]
    )
    share = F.col("place") / float(1 << 64) + 0.5
    smallest = Window.partitionBy("lang").orderBy("place")
    chosen = (
        labelled.where(share <= rate[F.col("lang")]).dropDuplicates(["lang", "place"])
        .withColumn("nth", F.row_number().over(smallest)).where(F.col("nth") <= sample)
        .select(number[F.col("lang")].cast("int").alias("lang"), "text")
    )

    context, width = docs.sparkSession.sparkContext, len(languages)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[int, Counter] = {}
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found.setdefault(lang, Counter()).update(words_of(text))
            for lang, words in found.items():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(words), pa.int32()), pa.array(list(words)),
                        pa.array(list(words.values()), pa.int64()),
                    ],
                    names=["lang", "word", "uses"],
                )

    types = materialise(
        chosen.mapInArrow(count, "lang int, word string, uses long")
        .groupBy("lang", "word").agg(F.sum("uses").alias("uses"))
        # a fixed number of parts: little data, but much work in each row
        .repartition(context.defaultParallelism, "word"),
        "language-words",
    )
    for _ in range(rounds):
        shared = context.broadcast(model)

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pieces = shared.value  # noqa: B023
            total = np.zeros_like(pieces.probability)
            for batch in batches:
                lang, word, uses = batch.columns
                for at in range(0, len(word), 2000):
                    own = lang.slice(at, 2000).to_numpy()
                    weight = np.zeros((len(own), width))
                    weight[np.arange(len(own)), own] = uses.slice(at, 2000).to_numpy()
                    total += pieces.expected(word.slice(at, 2000).to_pylist(), weight)
            piece, lang = np.nonzero(total[:-1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(piece.astype(np.int32)), pa.array(lang.astype(np.int32)),
                    pa.array(total[piece, lang]),
                ],
                names=["piece", "lang", "uses"],
            )

        sums = (
            types.mapInArrow(expect, "piece int, lang int, uses double")
            .groupBy("piece", "lang").agg(F.sum("uses").alias("uses"))
            .toPandas()  # at most pieces x languages
            .sort_values(["piece", "lang"])
        )
        counts_now = np.zeros((len(pieces), width))
        counts_now[sums["piece"], sums["lang"]] = np.round(sums["uses"], 6)
        # pieces never seen keep a little, the same for all languages
        counts_now += 0.01
        probability = np.vstack(
            [counts_now / counts_now.sum(axis=0), np.full(width, _UNKNOWN_CHARACTER)]
        )
        model = Pieces(model.index, probability, model.longest)
    return LanguageModel(languages, model)


class Predictor:
    """Scores texts, remembering the scores of the words met last."""

    def __init__(self, model: LanguageModel):
        self.model, self.width = model, len(model.languages)
        self.known: dict[str, int] = {}
        self.table = np.empty((0, self.width))

    def _rows(self, words: list[str]) -> np.ndarray:
        """Scores of the words, one row each."""
        new = set(words).difference(self.known)
        if len(self.known) + len(new) > _CACHED:
            # begin anew with what this batch uses
            kept = sorted(set(words) - new)
            self.table = self.table[[self.known[w] for w in kept]]
            self.known = {w: n for n, w in enumerate(kept)}
        if new:
            listed = sorted(new)
            self.known.update(zip(listed, range(len(self.known), len(self.known) + len(listed)),
                                  strict=True))
            self.table = np.concatenate([self.table, self.model.pieces.score(listed)])
        return self.table[np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))]

    def __call__(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        found = [words_of(t) if t and self.width else [] for t in texts]
        counts = np.array([len(w) for w in found])
        languages = np.full(len(texts), UNKNOWN, dtype=object)
        likeness = np.zeros(len(texts))
        some = np.flatnonzero(counts)
        if len(some):
            rows = self._rows(list(chain.from_iterable(found)))
            total = np.add.reduceat(rows, (np.cumsum(counts) - counts)[some])
            share = np.exp(total - total.max(axis=1, keepdims=True))
            best = share.argmax(axis=1)
            languages[some] = np.array(self.model.languages, dtype=object)[best]
            likeness[some] = share.max(axis=1) / share.sum(axis=1)
        return languages.tolist(), likeness.tolist()


def prediction(docs: DataFrame, model: LanguageModel, text_column: str = "text") -> Column:
    """``struct<lang_pred, score>`` of a text: the likeliest language and its share.

    A text that is null or has no letter is ``und`` with score 0, and so is every text when
    the model knows no language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predictor = Predictor(shared.value)
        for batch in batches:
            parts = []
            for at in range(0, max(1, len(batch)), 256):
                languages, scores = predictor(batch.iloc[at : at + 256].tolist())
                parts.append(pd.DataFrame({"lang_pred": languages, "score": scores}))
            yield pd.concat(parts, ignore_index=True)

    udf = F.pandas_udf(run, "lang_pred string, score double")
    return udf(named(text_column).cast("string"))


def held_out(id_column: str = "doc_id") -> Column:
    """A fixed quarter of the ids, kept from training; a null id is not held out."""
    quarter = F.crc32(named(id_column).cast("string").cast("binary")) % 4
    return F.coalesce(quarter == 2, F.lit(False))


def predict(
    docs: DataFrame,
    model: LanguageModel,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``, one row per row of ``docs``.

    Of equally likely languages the first by name counts. Whole texts are scored; rows that
    repeat an id are each predicted; an empty table gives none.
    """
    return docs.select(
        named(id_column).alias("doc_id"), held_out(id_column).alias("held_out"),
        prediction(docs, model, text_column).alias("found"),
    ).select("doc_id", "held_out", "found.lang_pred", "found.score")


def keep_known(
    docs: DataFrame, model: LanguageModel, *, least: float = 0.5, text_column: str = "text"
) -> DataFrame:
    """The rows whose text is in a known language with at least that score, all columns kept."""
    found = fresh(docs, "language")
    guessed = docs.withColumn(found, prediction(docs, model, text_column))
    kept = (F.col(found)["lang_pred"] != UNKNOWN) & (F.col(found)["score"] >= least)
    return guessed.where(kept).select(*[named(c) for c in docs.columns])
