"""Language by unigram pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed vocabulary. A word may be cut
into pieces in many ways; the forward algorithm adds up the probabilities of all of them,
and a text's likelihood is the product over its words. The pieces' probabilities are their
smoothed shares among all places in the training texts of a language where a piece occurs.

Texts are lower-cased, and words are their runs of letters. Counting and scoring work on the
distinct words of a chunk; counts are summed by language and piece, so only a table as large
as vocabulary times languages comes to the driver and goes out again.

Null text, and text without a letter, is ``und`` with score 0, and so is everything when
nothing could be learned. Rows without a language teach nothing. Equal likelihoods give the
smaller language name. Repeated rows count and score each time. Columns of docs with the
names of results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.bpe import LETTER, byte_classes
from waybill.llm.common import chunks, flat_text
from waybill.llm.tables import Trie

UNKNOWN = "und"
#: Each letter's probability is scaled by this, so that short words stay within a double's range.
SCALE = 1000.0
#: After as many letters, or as many as the longest piece has, a word's running values are rescaled.
RESCALE = 32
#: Languages that a model may hold; its size is that of the vocabulary times this.
MOST_LANGUAGES = 256
MARK = "▁"


class Pieces:
    """The vocabulary's pieces of letters, lower-cased; piece 0 is any unknown letter."""

    def __init__(self, pieces: list[str]):
        fit = {p.lower() for p in pieces}
        fit = sorted(p for p in fit if p and all(c.isalpha() for c in p.removeprefix(MARK)))
        alphabet = sorted({c for p in fit for c in p} | {MARK})
        self.letter = np.zeros(0x110000, dtype=np.int32)
        self.letter[[ord(c) for c in alphabet]] = np.arange(1, len(alphabet) + 1)
        coded = [(tuple(int(self.letter[ord(c)]) for c in p), i) for i, p in enumerate(fit, 2)]
        single = {c for c, _ in coded if len(c) == 1}
        rest = [((x,), 1 if x == self.letter[ord(MARK)] else 0) for x in range(len(alphabet) + 1) if (x,) not in single]
        self.trie, self.size = Trie(coded + rest), len(fit) + 2

    def places(self, letters: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple]:
        """For each letter of words, longest first: every piece that ends there.

        Yields the letter's index in the word and, for each of those pieces, the words (by
        number), the places of its last letter, its length and its number.
        """
        for i in range(int(sizes[0]) if len(sizes) else 0):
            word = np.arange(np.searchsorted(-sizes, -i))
            at, node = starts[word] + i, np.zeros(len(word), dtype=np.int64)
            for size in range(1, min(i + 1, self.trie.longest) + 1):
                node = self.trie.walk(node, letters[at - size + 1])
                go = node >= 0
                word, at, node = word[go], at[go], node[go]
                if not len(at):
                    break
                piece = self.trie.ends[node]
                hit = piece >= 0
                yield i, word[hit], at[hit], size, piece[hit]


class Words:
    """The letter runs of some texts: distinct ones as letters, and each text's numbers of them."""

    def __init__(self, pieces: Pieces, text: pa.Array):
        data, offsets = flat_text(pc.utf8_lower(text.cast(pa.large_string())))
        letter = byte_classes(data) == LETTER
        edge = np.diff(letter, prepend=False, append=False).astype(bool)
        edge[offsets[1:-1]] |= letter[offsets[1:-1] - 1] & letter[np.minimum(offsets[1:-1], len(data) - 1)] & (
            offsets[1:-1] < len(data)
        ) if len(data) else False
        marks = np.flatnonzero(edge)
        begin = marks[letter[np.minimum(marks, len(data) - 1)] & (marks < len(data))] if len(data) else marks
        size = np.diff(np.append(np.cumsum(letter)[begin] - 1, letter.sum()))
        ends = np.append(0, np.cumsum(size)).astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(begin), [None, pa.py_buffer(ends), pa.py_buffer(data[letter])]
        ).dictionary_encode()
        self.word = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.first = np.searchsorted(begin, offsets)
        flat, cuts = flat_text(words.dictionary)
        head = np.flatnonzero((flat & 0xC0) != 0x80)
        points = np.frombuffer(flat.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
        starts = np.searchsorted(head, cuts)
        self.letters = np.insert(pieces.letter[points], starts[:-1], pieces.letter[ord(MARK)]).astype(np.int64)
        self.owner = np.arange(len(starts) - 1)
        self.start, self.size = starts[:-1] + self.owner, np.diff(starts) + 1
        order = np.argsort(-self.size, kind="stable")
        self.start, self.size, self.owner = self.start[order], self.size[order], self.owner[order]


def _count(pieces: Pieces, batch: pa.RecordBatch, langs: list[str | None]) -> pa.RecordBatch:
    words = Words(pieces, batch.column("text"))
    names = sorted({x for x in langs if x is not None})
    number = {x: i for i, x in enumerate(names)}
    row = np.repeat(np.array([number.get(x, -1) for x in langs]), np.diff(words.first))
    n = int(words.word.max()) + 1 if len(words.word) else 0
    times = np.bincount((row * n + words.word)[row >= 0], minlength=n * len(names)).reshape(len(names), n)
    sums = np.zeros((len(names), pieces.size))
    for _, word, _, _, piece in pieces.places(words.letters, words.start, words.size):
        for i in range(len(names)):
            sums[i] += np.bincount(piece, times[i, words.owner[word]], minlength=pieces.size)
    lang, piece = np.nonzero(sums)
    return pa.RecordBatch.from_arrays(
        [pa.array(names).take(pa.array(lang)).cast(pa.string()), pa.array(piece.astype(np.int32)), pa.array(sums[lang, piece].astype(np.int64))],
        names=["lang", "piece", "n"],
    )


@dataclass
class Model:
    """Languages in order of name, and the log probability of each piece in each of them."""

    pieces: Pieces
    languages: list[str]
    chances: np.ndarray

    def word_logs(self, words: Words) -> np.ndarray:
        """Log probability of each distinct word in each language."""
        forward = np.zeros((len(words.letters), len(self.languages)))
        scaled = np.zeros((len(words.size), len(self.languages)))
        step, last = max(RESCALE, self.pieces.trie.longest), 0
        for i, _, at, size, piece in self.pieces.places(words.letters, words.start, words.size):
            if i > last and i % step == 0:
                # the values that the words' next letters still read
                word = np.arange(np.searchsorted(-words.size, -i))
                read = words.start[word][:, None] + i - 1 - np.arange(self.pieces.trie.longest)
                most = forward[read].max(axis=1)
                most[most == 0] = 1
                forward[read] /= most[:, None]
                scaled[word] += np.log(most)
            last = i
            share = self.chances[piece] * SCALE**size
            forward[at] += share * forward[at - size] if size <= i else share
        part = np.log(np.maximum(forward[words.start + words.size - 1], 1e-300)) - np.log(SCALE) * words.size[:, None]
        part += scaled
        logs = np.zeros((int(words.owner.max()) + 1 if len(words.owner) else 0, len(self.languages)))
        np.add.at(logs, words.owner, part)
        return logs


def learn(docs: DataFrame, pieces: list[str], lang: str = "lang", text: str = "text", smooth: float = 0.1) -> Model:
    """Piece probabilities of every language among the rows that have one."""
    known = Pieces(pieces)
    held = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            yield _count(held.value, batch, batch.column("lang").to_pylist())

    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counted = rows.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).mapInArrow(
        run, "lang string, piece int, n long"
    )
    sums = counted.groupBy("lang", "piece").agg(F.sum("n").alias("n"))
    table = sums.limit(MOST_LANGUAGES * known.size + 1).toArrow()
    languages = sorted(set(table["lang"].to_pylist()))
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    n = np.full((known.size, len(languages)), smooth)
    place = {x: i for i, x in enumerate(languages)}
    n[table["piece"].to_numpy(), [place[x] for x in table["lang"].to_pylist()]] += table["n"].to_numpy()
    return Model(known, languages, n / n.sum(axis=0))


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns, ``lang_pred``, ``score`` and ``fit``.

    ``score`` is the language's share of the likelihood of all. It compares the languages only, so
    ``fit`` tells how likely the text is at all: the mean log likelihood of its ``letters`` in the
    language, null without letters.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in docs.columns if c not in ("lang_pred", "score", "fit", "letters")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in chunks(batches, text):
            words = Words(model.pieces, batch.column(text))
            some = np.flatnonzero(np.diff(words.first) > 0) if model.languages else np.zeros(0, dtype=np.int64)
            pred, score = np.full(batch.num_rows, UNKNOWN, dtype=object), np.zeros(batch.num_rows)
            fit, letters = np.zeros(batch.num_rows), np.zeros(batch.num_rows, dtype=np.int64)
            if len(some):
                logs = np.add.reduceat(model.word_logs(words)[words.word], words.first[some])
                best = logs.argmax(axis=1)
                pred[some] = np.array(model.languages, dtype=object)[best]
                sizes = np.bincount(words.owner, words.size)
                letters[some] = np.add.reduceat(sizes[words.word], words.first[some])
                fit[some] = logs.max(axis=1) / letters[some]
                score[some] = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
            added = [pa.array(pred, type=pa.string()), pa.array(score), pa.array(fit, mask=letters == 0), pa.array(letters)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*names, "lang_pred", "score", "fit", "letters"])

    rows = docs.select(*(F.col(f"`{c}`") for c in names))
    added = {"lang_pred": "string", "score": "double", "fit": "double", "letters": "long"}
    schema = rows.withColumns({c: F.lit(None).cast(kind) for c, kind in added.items()}).schema
    return rows.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept out of training; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1
