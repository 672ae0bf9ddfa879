"""Class-based bigram language model after Brown: exchange clustering, then scoring.

``P(w | v) = P(class(w) | class(v)) * P(w | class(w))``.  Every word has a class: frequent
words are assigned to one each by itself, all others - unknown ones too - with the words
of the same form, a hash of their last three bytes.  What is frequent is a share of the
training tokens, so at most ``1 / OWN`` words and ``FORMS`` forms are exchanged, and at
most ``1 / KNOWN`` words are sent to the tasks, however large the corpus.  The counts of
all other words stay in a table that the documents' words are joined with.

Exchange clustering moves a word to the class that raises the likelihood of the class
bigrams most.  A row for each word holds its neighbours with their counts; a round
evaluates a third of the words in parallel against the class bigrams of the round before.

Inside a class, absolute discounting frees the mass of its unknown words; transitions
are smoothed towards the classes' shares.  The probabilities of all known words and of
the classes' unknown words add up to one after any word.

Texts are lower-cased in A-Z only and cut at ``[\\x20\\x09-\\x0D]``; a text ends with one
end token, which is also what its first word follows.  A null text is empty; an empty
text is its end token.  Rows with a null ``doc_id`` are not held out.  Repeated rows are
texts of their own; other columns make no difference.  Without training text every score
is that of unknown words and the base score is 0.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import Written

FOLDS = 10
CLASSES = 64
#: Share of the training tokens from which a word is exchanged by itself, and known to tasks.
OWN, KNOWN = 2e-5, 1e-6
FORMS, FORM_BYTES = 4096, 3
#: Sweeps over all words, and the parts of the words that move at the same time.
SWEEPS, PARTS = 6, 3
#: A sweep that raises the likelihood by less than this share is the last.
LEAST_GAIN = 2e-4
#: Weight, in tokens, of the classes' shares in a transition.
PRIOR = 5.0
#: Tokens counted together, bytes of text cut into words at a time, rows of a batch.
CHUNK, PIECE, ROWS = 4_000_000, 4_000_000, 200_000
END = b""
_SPACE = b" \t\n\x0b\x0c\r"


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(False))


def word_pieces(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text in pieces, so that a very long text is never split at once."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if len(data) <= PIECE:
        yield data.lower().split()
        return
    start = 0
    while start < len(data):
        end = min(start + PIECE, len(data))
        while end < len(data) and data[end] not in _SPACE:
            end += 1
        yield data[start:end].lower().split()
        start = end


def form(word: bytes) -> int:
    return crc32(word[-FORM_BYTES:]) % FORMS


def _form_column(word: Column) -> Column:
    last = F.substring(word, -FORM_BYTES, FORM_BYTES)
    short = F.octet_length(word) <= FORM_BYTES
    return F.pmod(F.crc32(F.when(short, word).otherwise(last)), F.lit(FORMS))


# --- counts -----------------------------------------------------------------------------


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, c)`` of all training tokens; the end token is the empty word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for words in word_pieces(text):
                    found.update(words)
                found[END] += 1
                if len(found) > ROWS:
                    yield _counted(found)
                    found = Counter()
        if found:
            yield _counted(found)

    train = docs.where(~held_out()).select("text")
    return train.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


def _counted(found: Counter[bytes]) -> pa.RecordBatch:
    words, counts = pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())
    return pa.RecordBatch.from_arrays([words, counts], ["word", "n"])


@dataclass(frozen=True)
class Lexicon:
    """The words that tasks know, most frequent first, and totals of the training tokens.

    Units are the end token, the first ``own`` words, and the forms.
    """

    words: list[bytes]
    counts: np.ndarray
    own: int
    tokens: int
    ends: int
    distinct: int
    discount: float
    form_words: np.ndarray  # distinct words of each form that have no unit of their own

    @property
    def units(self) -> int:
        return 1 + self.own + FORMS

    def unit_of(self) -> np.ndarray:
        """The unit of each known word."""
        forms = [1 + self.own + form(w) for w in self.words[self.own :]]
        return np.r_[np.arange(1, self.own + 1), np.array(forms, dtype=np.int64)].astype(np.int32)


def lexicon(counts: DataFrame) -> Lexicon:
    """Totals and the words of at least the share ``KNOWN``; at most ``1 / KNOWN`` are sent."""
    totals = counts.agg(
        F.sum("c").alias("tokens"),
        F.sum(F.when(F.octet_length("word") == 0, F.col("c"))).alias("ends"),
        F.count("*").alias("distinct"),
        F.count_if(F.col("c") == 1).alias("ones"),
        F.count_if(F.col("c") == 2).alias("twos"),
    ).first()
    tokens = totals.tokens or 0
    words = counts.where(F.octet_length("word") > 0)
    known = words.where(F.col("c") >= KNOWN * tokens).toArrow()
    pairs = sorted(zip(known["word"].to_pylist(), known["c"].to_pylist(), strict=True), key=lambda p: (-p[1], p[0]))
    own = sum(c >= OWN * tokens for _, c in pairs)
    others = words.where(F.col("c") < OWN * tokens)
    form_words = np.zeros(FORMS)
    for r in others.groupBy(_form_column(F.col("word")).alias("form")).agg(F.count("*").alias("n")).collect():
        form_words[r.form] = r.n
    share = totals.ones / (totals.ones + 2 * totals.twos) if totals.ones else 0.5
    return Lexicon(
        [w for w, _ in pairs],
        np.array([c for _, c in pairs], dtype=np.int64),
        own,
        tokens,
        totals.ends or 0,
        totals.distinct,
        min(max(share, 0.05), 0.95),
        form_words,
    )


class _Reader:
    """Words to places in the lexicon and to units, inside a task."""

    def __init__(self, lex: Lexicon) -> None:
        self.place = {w: i for i, w in enumerate(lex.words)}
        self.unit, self.first_form = lex.unit_of(), 1 + lex.own

    def read(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """Places (-1 if not known), units, where words are not known, and those words."""
        places = np.fromiter(map(self.place.get, words, repeat(-1)), np.int32, len(words))
        missing = np.flatnonzero(places < 0)
        others = [words[i] for i in missing]
        units = self.unit[places] if len(self.unit) else np.zeros(len(words), np.int32)
        units[missing] = np.fromiter(map(form, others), np.int32, len(others)) + self.first_form
        return places, units, missing, others


def neighbours(docs: DataFrame, lex: Lexicon) -> DataFrame:
    """``(unit, after, before)``: the units beside each unit in training text, with counts.

    Pairs are added up first, so that a row holds at most one entry for each unit.
    """
    shared = docs.sparkSession.sparkContext.broadcast(lex)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, size = _Reader(shared.value), shared.value.units
        held, tokens = [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                last = np.zeros(1, np.int64)
                for words in word_pieces(text):
                    path = np.concatenate([last, reader.read(words)[1]])
                    held.append(path[:-1] * size + path[1:])
                    last, tokens = path[-1:], tokens + len(words)
                held.append(last * size)
                if tokens > CHUNK:
                    yield _pairs(held, size)
                    held, tokens = [], 0
        if held:
            yield _pairs(held, size)

    train = docs.where(~held_out()).select("text")
    pairs = train.mapInArrow(count, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    pairs = Written(pairs, "unit-pairs")
    after = pairs.df.select(F.col("a").alias("unit"), F.struct("b", "n").alias("after"), F.lit(None).alias("before"))
    before = pairs.df.select(F.col("b").alias("unit"), F.lit(None).alias("after"), F.struct("a", "n").alias("before"))
    both = after.unionAll(before).groupBy("unit")
    rows = Written(both.agg(F.collect_list("after").alias("after"), F.collect_list("before").alias("before")), "units")
    pairs.drop()
    return rows.df


def _pairs(held: list[np.ndarray], size: int) -> pa.RecordBatch:
    codes, counts = np.unique(np.concatenate(held), return_counts=True)
    a, b = np.divmod(codes, size)
    arrays = [pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(counts.astype(np.int64))]
    return pa.RecordBatch.from_arrays(arrays, ["a", "b", "n"])


# --- exchange clustering ----------------------------------------------------------------


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def likelihood(bigrams: np.ndarray) -> float:
    """What class bigrams add to the log likelihood; higher is better."""
    return float(_xlogx(bigrams).sum() - _xlogx(bigrams.sum(0)).sum() - _xlogx(bigrams.sum(1)).sum())


def _by_class(column: pa.Array, classes: np.ndarray, size: int) -> np.ndarray:
    """Counts of each row's neighbours by class."""
    inner = column.flatten()
    rows = np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy()))
    other, n = (inner.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    flat = np.bincount(rows * size + classes[other], weights=n, minlength=len(column) * size)
    return flat.reshape(len(column), size)


def best_classes(
    after: np.ndarray, before: np.ndarray, own: np.ndarray, bigrams: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The best class of each word and what the move gains, by its neighbours' classes.

    ``own`` are the classes the words are in now, less which they are compared.  Class 0
    is the end token's alone.
    """
    size, best, gain = len(bigrams), np.empty(len(own), np.int64), np.empty(len(own))
    for start in range(0, len(own), 64):
        part = slice(start, start + 64)
        mine, at = own[part], np.arange(len(own[part]))
        worth = np.zeros((len(mine), size))
        for counts, matrix in ((after[part], bigrams), (before[part], bigrams.T)):
            grown = _xlogx(matrix[None] + counts[:, None, :]).sum(2) - _xlogx(matrix).sum(1)
            held, n, total = matrix[mine], counts.sum(1), matrix.sum(1)
            grown[at, mine] = (_xlogx(held) - _xlogx(np.maximum(held - counts, 0.0))).sum(1)
            spent = _xlogx(total + n[:, None]) - _xlogx(total)
            spent[at, mine] = _xlogx(total[mine]) - _xlogx(np.maximum(total[mine] - n, 0.0))
            worth += grown - spent
        worth[:, 0] = -np.inf
        best[part] = worth.argmax(1)
        gain[part] = worth.max(1) - worth[at, mine]
    return best, gain


def class_bigrams(rows: DataFrame, classes: np.ndarray, size: int) -> np.ndarray:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                own = classes[batch.column(0).to_numpy()]
                np.add.at(total, own, _by_class(batch.column(1), classes, size))
        cells = np.flatnonzero(total)
        arrays = [pa.array(cells.astype(np.int32)), pa.array(total.ravel()[cells].astype(np.int64))]
        yield pa.RecordBatch.from_arrays(arrays, ["cell", "n"])

    sums = rows.select("unit", "after").mapInArrow(count, "cell int, n long")
    out = np.zeros(size * size)
    for r in sums.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[r.cell] = r.n
    return out.reshape(size, size)


def _moves(rows: DataFrame, classes: np.ndarray, bigrams: np.ndarray, part: int) -> list:
    size = len(bigrams)

    def evaluate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = batch.column(0).to_numpy()
            after, before = (_by_class(batch.column(i), classes, size) for i in (1, 2))
            best, gain = best_classes(after, before, classes[unit], bigrams)
            moved = gain > 1e-9
            arrays = [pa.array(unit[moved]), pa.array(best[moved].astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, ["unit", "best"])

    mine = rows.where((F.col("unit") > 0) & (F.pmod(F.hash("unit"), F.lit(PARTS)) == part))
    return mine.mapInArrow(evaluate, "unit int, best int").collect()


def exchange(rows: DataFrame, lex: Lexicon, size: int = CLASSES) -> tuple[np.ndarray, np.ndarray]:
    """A class for each unit, and the class bigrams.

    The most frequent words begin in classes of their own.  A round that lowers the
    likelihood, which moves at the same time can do, is taken back.  The driver holds one
    small number for each unit, of which there are at most ``1 / OWN + FORMS``.
    """
    classes = np.r_[0, 1 + np.arange(lex.own) % (size - 1), 1 + np.arange(FORMS) % (size - 1)].astype(np.int16)
    bigrams = class_bigrams(rows, classes, size)
    reached = likelihood(bigrams)
    for _ in range(SWEEPS):
        before = reached
        for part in range(PARTS):
            following = classes.copy()
            for unit, best in _moves(rows, classes, bigrams, part):
                following[unit] = best
            counted = class_bigrams(rows, following, size)
            value = likelihood(counted)
            if value > reached:
                classes, bigrams, reached = following, counted, value
        if reached - before <= LEAST_GAIN * abs(reached):
            break
    return classes, bigrams


# --- the model --------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """Logarithms to base 10 of a fitted model, and the counts of words tasks do not know."""

    lex: Lexicon
    counts: DataFrame
    classes: np.ndarray
    transition: np.ndarray  # [class before, class]
    class_size: np.ndarray  # log10 of the training tokens of each class
    unknown: np.ndarray  # log10 of the mass of a class's unknown words, in tokens


def train(docs: DataFrame, classes: int = CLASSES) -> Model:
    """Count, cluster and smooth; every training document takes part."""
    counts = Written(word_counts(docs), "word-counts").df
    lex = lexicon(counts)
    assigned, bigrams = exchange(neighbours(docs, lex), lex, classes)
    return _smoothed(lex, counts, assigned, bigrams)


def _smoothed(lex: Lexicon, counts: DataFrame, classes: np.ndarray, bigrams: np.ndarray) -> Model:
    size, total = len(bigrams), bigrams.sum(0)
    share = (total + 1.0) / (total.sum() + size)
    rows = bigrams.sum(1, keepdims=True)
    transition = np.log10((bigrams + PRIOR * share) / (rows + PRIOR))
    distinct = np.bincount(classes[1 : 1 + lex.own], minlength=size).astype(float)
    distinct += np.bincount(classes[1 + lex.own :], weights=lex.form_words, minlength=size)
    freed = lex.discount * distinct
    return Model(
        lex,
        counts,
        classes,
        transition,
        np.log10(np.where(total > 0, total, 1.0)),
        np.log10(np.where(freed > 0, freed, 1.0)),
    )


_NAMES = ("row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "word", "n", "class")


def _scored(docs: DataFrame, model: Model) -> DataFrame:
    """A row for each document, and one for each of its words that tasks do not know.

    The former have no ``word``; the latter name the document's ``row``.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, "
        "score double, word binary, n long, class int"
    )
    parts = (model.lex, model.classes, model.transition, model.class_size, model.unknown)
    shared = docs.sparkSession.sparkContext.broadcast(parts)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, classes, transition, class_size, unknown = shared.value
        reader, missing_emission = _Reader(lex), unknown - class_size
        emission = np.log10(lex.counts - lex.discount) - class_size[classes[reader.unit]]
        of_total = np.log10(lex.tokens + 0.1 * (lex.distinct + 1))
        base_of, base_unknown = np.log10(lex.counts + 0.1), float(np.log10(0.1))
        base_end, end_known = float(np.log10(lex.ends + 0.1)), int(lex.ends > 0)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            docs_out: list[list] = [[] for _ in range(7)]
            words_out: list[list] = [[] for _ in range(4)]
            for doc_id, held, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                last, tokens, known, base, value = 0, 1, end_known, base_end, 0.0
                missed: Counter[bytes] = Counter()
                for words in word_pieces(text):
                    if not words:
                        continue
                    places, units, missing, others = reader.read(words)
                    path, hit = classes[units], places[places >= 0]
                    value += transition[last, path[0]] + transition[path[:-1], path[1:]].sum()
                    value += emission[hit].sum() + missing_emission[path[missing]].sum()
                    base += base_of[hit].sum() + len(others) * base_unknown
                    last, tokens, known = path[-1], tokens + len(words), known + len(hit)
                    missed.update(others)
                value += transition[last, 0]
                found = (row, doc_id, held, tokens, known, base - tokens * of_total, value)
                for column, item in zip(docs_out, found, strict=True):
                    column.append(item)
                words_out[0].extend(repeat(row, len(missed)))
                words_out[1].extend(missed.keys())
                words_out[2].extend(missed.values())
                words_out[3].extend(int(classes[reader.first_form + form(w)]) for w in missed)
                row += 1
                if len(words_out[0]) > ROWS:
                    yield _words_frame(words_out, batch.schema.field(0).type)
                    words_out = [[] for _ in range(4)]
            yield _docs_frame(docs_out, batch.schema.field(0).type)
            yield _words_frame(words_out, batch.schema.field(0).type)

    return docs.select("doc_id", held_out(), "text").mapInArrow(score, schema)


def _docs_frame(columns: list[list], kind: pa.DataType) -> pa.RecordBatch:
    kinds = [pa.int64(), kind, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    arrays += [pa.nulls(len(columns[0]), k) for k in (pa.binary(), pa.int64(), pa.int32())]
    return pa.RecordBatch.from_arrays(arrays, list(_NAMES))


def _words_frame(columns: list[list], kind: pa.DataType) -> pa.RecordBatch:
    size = len(columns[0])
    kinds = [kind, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    arrays = [pa.array(columns[0], pa.int64()), *[pa.nulls(size, k) for k in kinds]]
    for values, k in zip(columns[1:], (pa.binary(), pa.int64(), pa.int32()), strict=True):
        arrays.append(pa.array(values, k))
    return pa.RecordBatch.from_arrays(arrays, list(_NAMES))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every row.

    Words that tasks do not know are scored as unknown first; those that the table of
    counts holds are corrected by a join, whose sums go back to their documents.
    """
    lex = model.lex
    written = Written(_scored(docs, model), "scored").df
    words = written.where("word IS NOT NULL").select("row", "word", "n", "class")
    counts = model.counts.where((F.octet_length("word") > 0) & (F.col("c") < KNOWN * lex.tokens))
    unknown = F.get(F.array(*[F.lit(float(u)) for u in model.unknown]), F.col("class"))
    more = F.log10(F.col("c") - F.lit(lex.discount)) - unknown
    base = F.log10(F.col("c") + F.lit(0.1)) + F.lit(1.0)
    found = words.join(counts, "word").groupBy("row").agg(
        F.sum("n").alias("more_known"),
        F.sum(F.col("n") * base).alias("more_base"),
        F.sum(F.col("n") * more).alias("more_score"),
    )
    scored = written.where("word IS NULL").drop("word", "n", "class").join(found, "row", "left")
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(lex.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )


def perplexities(scored: DataFrame) -> DataFrame:
    """``(held_out, n_tokens, base_perplexity, perplexity)`` over all scored rows."""
    per_token = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scored.groupBy("held_out").agg(
        F.sum("n_tokens").alias("n_tokens"),
        per_token("base_score").alias("base_perplexity"),
        per_token("score").alias("perplexity"),
    )
