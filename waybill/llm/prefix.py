"""Token counts of every prefix by dynamic programming.

For a BPE vocabulary the last token of each prefix is fixed: it is the one token that ends
there and may follow the last token of the prefix before it. Two tokens may stand side by
side if merging their text gives back just these two, which is read off the merges that made
them. So one pass over a word gives the count of all its prefixes, and cutting a text to a
budget, or asking how much of it fits, needs no second encoding.

The vocabulary is that of a sentencepiece BPE model with byte fallback: a space is the
character U+2581, a text starts with one, and no token has one behind another character.
So words are counted on their own, each distinct word of a chunk once, all of a chunk
together as arrays. Nothing is shuffled and a task holds one chunk.

Null text is empty text and has no tokens; repeated rows are counted alike; columns of docs
with the names of results are replaced, all others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import chunks, flat_text, lists, ranges
from waybill.llm.tables import Table, Trie

#: The character that stands for a space, and its UTF-8 form.
MARK = "▁"
MARK_BYTES = MARK.encode()
#: Words of more characters are counted one by one.
ARRAY_CHARS = 64


def _run_tokens(n: int, known: set[int]) -> int:
    """Tokens of n spaces on their own: the leftmost pair that makes a piece merges first."""
    parts = [1] * n
    while True:
        at = next((i for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in known), None)
        if at is None:
            return len(parts)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]


class Vocabulary:
    """Pieces of a BPE model: those of one character are its alphabet, the others merges.

    Merges are numbered behind the alphabet in the order in which they are made. A character
    outside the alphabet is as many tokens as it has bytes and never merges.
    """

    def __init__(self, scores: dict[str, float], bytes_too: bool = True):
        if not bytes_too:
            raise ValueError("the model needs byte fallback")
        letters = sorted(p for p in scores if len(p) == 1)
        runs = {p for p in scores if set(p) == {MARK} and len(p) > 1}
        merges = sorted((p for p in scores if len(p) > 1 and p not in runs), key=lambda p: -scores[p])
        if len({scores[p] for p in merges}) < len(merges) or any(MARK in p[1:] for p in merges):
            raise ValueError("scores must differ, and spaces lead a piece")
        self.longest_run = max([1, *map(len, runs)])
        self.run_tokens = np.array([_run_tokens(n, set(map(len, runs))) for n in range(self.longest_run)])
        for n in range(3 * self.longest_run):
            if _run_tokens(n, set(map(len, runs))) != self.spaces(np.array(n)):
                raise ValueError("spaces must merge up to their longest piece")
        if runs and max(scores[p] for p in runs) >= min(scores[p] for p in merges):
            raise ValueError("spaces merge last")
        self.unknown = len(letters)
        self.first_merge = self.unknown + 1
        number = {p: i for i, p in enumerate(letters)} | {
            p: i for i, p in enumerate(merges, self.first_merge)
        }
        self.mark = number.get(MARK, self.unknown)
        self.letter = np.full(0x110000, self.unknown, dtype=np.int32)
        for p in letters:
            self.letter[ord(p)] = number[p]
        self.pairs = {
            (number[p[:i]] << 17) + number[p[i:]]: number[p]
            for p in merges
            for i in range(1, len(p))
            if p[:i] in number and p[i:] in number
        }
        self.left = np.arange(self.first_merge + len(merges))
        self.right = self.left.copy()
        words = [((self.unknown,), self.unknown)]
        for p in [*letters, *merges]:
            made = self._made(p, number)
            if made is not None:
                words.append((tuple(number[c] for c in p), number[p]))
                if len(p) > 1:
                    self.left[number[p]], self.right[number[p]] = made
        self.trie, self.table = Trie(words), Table(self.pairs)

    def spaces(self, n: np.ndarray) -> np.ndarray:
        """Tokens of n spaces on their own."""
        return n // self.longest_run + self.run_tokens[n % self.longest_run]

    def _made(self, piece: str, number: dict[str, int]) -> tuple[int, int] | None:
        """The two parts that merge last into the piece; None if merging gives something else."""
        if any(c not in number for c in piece):
            return None
        parts, made = [number[c] for c in piece], (0, 0)
        while len(parts) > 1:
            found = [(self.pairs.get((a << 17) + b, 1 << 20), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            best, i = min(found)
            if best == 1 << 20:
                return None
            made = (parts[i], parts[i + 1])
            parts[i : i + 2] = [best]
        return made if parts[0] == number[piece] else None

    def may_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether token ``b`` may stand behind token ``a``.

        The two are taken apart again, the later merge first; no part of ``a`` may have merged
        with its neighbour in ``b`` before the merge that was taken back.
        """
        fine = np.ones(len(a), dtype=bool)
        row, limit = np.arange(len(a)), np.full(len(a), 1 << 20)
        while len(row):
            crossed = self.table.get((a << 17) + b, 1 << 20) < limit
            fine[row[crossed]] = False
            go = ~crossed & ((a >= self.first_merge) | (b >= self.first_merge))
            row, a, b = row[go], a[go], b[go]
            later = a > b
            limit = np.where(later, a, b + 1)
            a, b = np.where(later, self.right[a], a), np.where(later, b, self.left[b])
        return fine

    def counts(self, letters: np.ndarray, cost: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        """Of each prefix of words, longest word first: its count, and whether it leads with a lone space.

        Both stand at the place of the prefix's last letter.
        """
        last = np.zeros(len(letters), dtype=np.int64)
        count, lone = np.zeros(len(letters), dtype=np.int32), np.zeros(len(letters), dtype=bool)
        for i in range(int(sizes[0]) if len(sizes) else 0):
            at = starts[: np.searchsorted(-sizes, -i)] + i
            node = np.zeros(len(at), dtype=np.int64)
            for size in range(1, min(i + 1, self.trie.longest) + 1):
                begin = at - size + 1
                node = self.trie.walk(node, letters[begin])
                token = np.where(node >= 0, self.trie.ends[node], -1)
                hit = np.flatnonzero(token >= 0)
                if size <= i:
                    before = begin[hit] - 1
                    hit = hit[self.may_follow(last[before], token[hit])]
                    before = begin[hit] - 1
                    base, lead = count[before], lone[before]
                else:
                    base, lead = 0, token[hit] == self.mark
                here = at[hit]
                last[here], lone[here] = token[hit], lead
                count[here] = base + np.where(size == 1, cost[here], 1)
                rest = node >= 0
                rest[hit] = False
                at, node = at[rest], node[rest]
                if not len(at):
                    break
        return count, lone

    def long_counts(self, letters: list[int], cost: list[int]):
        """The same of one word of any length."""
        last, count, lone, fits = [], [], [], {}
        for i, c in enumerate(letters):
            node = 0
            for begin in range(i, max(-1, i - self.trie.longest), -1):
                node = self.trie.step.one((node << 17) + letters[begin])
                if node is None:
                    raise ValueError("no token ends here")
                token = int(self.trie.ends[node])
                if token < 0:
                    continue
                if begin:
                    key = (last[begin - 1], token)
                    if key not in fits:
                        fits[key] = bool(self.may_follow(*(np.array([x]) for x in key))[0])
                    if not fits[key]:
                        continue
                last.append(token)
                count.append((count[begin - 1] if begin else 0) + (cost[i] if begin == i else 1))
                lone.append(lone[begin - 1] if begin else token == self.mark)
                break
        return count, lone


class Chunk:
    """The words of some texts, the counts of their distinct words, and those of the texts."""

    def __init__(self, vocabulary: Vocabulary, text: pa.Array):
        self.vocabulary = vocabulary
        data, offsets = flat_text(text)
        self.bytes = np.diff(offsets)
        if MARK_BYTES in data.tobytes():
            column = pa.array([(t or "").replace(MARK, " ") for t in text.to_pylist()])
            data, offsets = flat_text(column)
        some = np.diff(offsets) > 0
        data = np.insert(data, offsets[:-1][some], 0x20)
        offsets = offsets + np.append(0, np.cumsum(some))
        starts = np.flatnonzero(data == 0x20)
        ends = np.append(starts, len(data))
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)]
        ).dictionary_encode()
        self.word = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self._count_words(*flat_text(words.dictionary))
        self.first = np.searchsorted(starts, offsets)
        self._count_texts()

    def _count_words(self, data: np.ndarray, offsets: np.ndarray) -> None:
        head = np.flatnonzero((data & 0xC0) != 0x80)
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        width = np.diff(np.append(head, len(data)))
        points[points == 0x20] = ord(MARK)
        letters = self.vocabulary.letter[points].astype(np.int64)
        cost = np.where(letters == self.vocabulary.unknown, width, 1)
        cost = np.where(points == ord(MARK), 1 if self.vocabulary.mark != self.vocabulary.unknown else 3, cost)
        cuts = np.searchsorted(head, offsets)
        self.start, self.size = cuts[:-1], np.diff(cuts)
        order = np.argsort(-self.size, kind="stable")
        many = int(np.searchsorted(-self.size[order], -ARRAY_CHARS))
        short = order[many:]
        self.count, self.lone = self.vocabulary.counts(letters, cost, self.start[short], self.size[short])
        for w in order[:many]:
            span = slice(self.start[w], self.start[w] + self.size[w])
            self.count[span], self.lone[span] = self.vocabulary.long_counts(
                letters[span].tolist(), cost[span].tolist()
            )

    def _count_texts(self) -> None:
        """Tokens up to the end of each word; spaces that no word takes merge among themselves."""
        word, n = self.word, len(self.word)
        empty = self.size[word] == 1
        at = np.arange(n)
        begin = np.zeros(n, dtype=bool)
        begin[self.first[:-1][self.first[:-1] < self.first[1:]]] = True
        run = np.maximum.accumulate(np.where(~empty | begin, at, 0)) if n else at
        # words without letters since the last word with some, this one among them
        spaces = np.where(empty, at - run + (empty[run] if n else 0), 0)
        before = np.where(begin, 0, np.append(0, spaces[:-1])) if n else spaces
        end = self.start[word] + self.size[word] - 1
        lone = self.lone[end]
        own = np.where(
            empty, self.vocabulary.spaces(spaces) - self.vocabulary.spaces(before), self.count[end] - lone + self.vocabulary.spaces(before + lone) - self.vocabulary.spaces(before)
        )
        self.before, self.total = before, np.append(0, np.cumsum(own))

    def tokens(self) -> np.ndarray:
        return np.diff(self.total[self.first])

    def prefixes(self, row: int) -> np.ndarray:
        """Tokens of the first 1, 2, ... characters of a text."""
        some = slice(self.first[row], self.first[row + 1])
        word, spaces = self.word[some], self.before[some]
        done = self.total[some] - self.total[some.start]
        # a lone space that leads a word joins the spaces before it
        joined = self.vocabulary.spaces(spaces + 1) - self.vocabulary.spaces(spaces) - 1
        size = self.size[word]
        at = ranges(self.start[word], size)
        return (self.count[at] + np.repeat(done, size) + self.lone[at] * np.repeat(joined, size))[1:]


def vocabulary(model_file: str) -> Vocabulary:
    """The pieces of a sentencepiece model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    ids = range(model.get_piece_size())
    scores = {
        model.id_to_piece(i): model.get_score(i)
        for i in ids
        if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i))
    }
    return Vocabulary(scores, sum(map(model.is_byte, ids)) == 256)


RESULT = {"n_bytes": "long", "n_tokens": "long", "fit_chars": "long", "prefix_tokens": "array<int>"}


def count_tokens(
    docs: DataFrame, pieces: Vocabulary, limit: int, prefixes: bool = False, text: str = "text"
) -> DataFrame:
    """All columns and ``n_bytes, n_tokens, fit_chars`` of the text, and ``prefix_tokens`` on demand.

    ``fit_chars`` is the length of the longest prefix of at most ``limit`` tokens, and
    ``prefix_tokens`` the tokens of the first 1, 2, ... characters.
    """
    if limit < 1:
        raise ValueError("the limit is 1 token at least")
    held = docs.sparkSession.sparkContext.broadcast(pieces)
    result = {k: v for k, v in RESULT.items() if prefixes or k != "prefix_tokens"}
    names = [c for c in docs.columns if c not in result]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            chunk = Chunk(held.value, batch.column(text))
            tokens = chunk.tokens()
            chars = pa.compute.fill_null(pa.compute.utf8_length(batch.column(text)), 0).cast(pa.int64())
            fit = chars.to_numpy().copy()
            for row in np.flatnonzero(tokens > limit):
                fit[row] = np.max(np.flatnonzero(chunk.prefixes(row) <= limit) + 1, initial=0)
            added = [pa.array(chunk.bytes), pa.array(tokens.astype(np.int64)), pa.array(fit)]
            if prefixes:
                rows = [chunk.prefixes(r) for r in range(batch.num_rows)]
                ends = np.append(0, np.cumsum([len(r) for r in rows]))
                added.append(lists(np.concatenate(rows), ends, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*names, *result])

    rows = docs.select(*(F.col(f"`{c}`") for c in names))
    return rows.mapInArrow(run, rows.withColumns({k: F.lit(None).cast(v) for k, v in result.items()}).schema)
