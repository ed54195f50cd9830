"""License texts found by diagonal voting.

All rolling k-grams of a document's words are hashed and joined by Spark to the places where
the templates have them. A match at word ``p`` of the document and ``t`` of a template votes
for the diagonal ``p - t``: a copy gives all its votes to one diagonal, and an inserted or
missing word moves the rest of it to a neighbouring one. Votes are summed by diagonal, so a
template's common words cost a document one row each at most. Neighbouring diagonals are merged,
and a merged span counts if the longest chain of matches that go forward in both texts covers
enough of the template. A second hash of each match is compared after the join.

Templates share passages, so one text may cover enough of several. A place in the document
counts for one label only, that of the span of largest coverage there; a span of another label
stays if the places left to it still cover enough of its template.

A phrase is a template that must match whole: all votes of its diagonal. Words are runs of
ASCII letters and digits and of all other characters beyond ASCII, with A-Z lower-cased.

Every row of docs gives one row, repeated ones and those with null ids too: a number given to
each row while it is read is the key. Null text is empty text, without words and labels.
Docs must be read in the same order again if a task is lost, as files are.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import chunks, flat_text

#: Words of a k-gram.
GRAM = 3
#: Words of all templates together, at most; their k-grams are sent to every task.
TEMPLATE_WORDS = 100_000
#: Diagonals this near to each other are one span, and this share of a template makes a label.
SLACK, SHARE = 8, 0.6

# The phrases of the base labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
# License texts as published, by label.
TEXTS = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
THE SOFTWARE.""",
    "apache-2": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright
notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided
with the distribution.""",
    "gpl": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public
License for more details.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "cc-by-nc": """This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International
License. To view a copy of this license, visit http://creativecommons.org/licenses/by-nc/4.0/""",
    "cc-by": """This work is licensed under the Creative Commons Attribution 4.0 International License. To view a copy of
this license, visit http://creativecommons.org/licenses/by/4.0/""",
}


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    whole: bool


TEMPLATES = tuple(Template(v, k, True) for k, v in PHRASES.items()) + tuple(
    Template(k, v, False) for k, v in TEXTS.items()
)
_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
#: Odd numbers that weigh the words of a k-gram, for its two hashes.
_FACTORS = np.array(
    [[xxhash.xxh3_64_intdigest(f"{a} {b}") | 1 for b in range(GRAM)] for a in range(2)], dtype=np.uint64
)
#: Stands for the end of a document instead of a k-gram.
_END = -1


def _word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of texts one after the other, and each text's first word."""
    data = _LOWER[data]
    inside = _WORD[data]
    begins = np.append(False, inside)[:-1]
    begins = inside & ~begins
    cut = offsets[:-1][np.diff(offsets) > 0]
    begins[cut] = inside[cut]
    starts = np.flatnonzero(begins)
    order = np.cumsum(inside) - 1
    ends = np.append(order[starts], inside.sum()).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data[inside]))]
    ).dictionary_encode()
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words.dictionary.to_pylist()], dtype=np.uint64)
    return hashes[words.indices.to_numpy(zero_copy_only=False)], np.searchsorted(starts, offsets)


def _grams(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both hashes of the k-gram that starts at each word but the last ones."""
    n, both = max(0, len(words) - GRAM + 1), []
    for factors in _FACTORS:
        mixed = np.zeros(n, dtype=np.uint64)
        for i, factor in enumerate(factors):
            part = words[i : i + n] * factor
            mixed += part ^ (part >> np.uint64(29 + i))
        mixed ^= mixed >> np.uint64(32)
        both.append((mixed >> np.uint64(1)).astype(np.int64))
    return both[0], both[1]


def _template_grams(spark, templates: tuple[Template, ...]) -> tuple[DataFrame, list[int]]:
    rows, sizes, words = [(_END, None, -1, 0)], [], 0
    for number, template in enumerate(templates):
        data = np.frombuffer(template.text.encode(), dtype=np.uint8)
        hashes, _ = _word_hashes(data, np.array([0, len(data)]))
        words += len(hashes)
        if len(hashes) < GRAM:
            raise ValueError(f"a template needs {GRAM} words: {template.text!r}")
        grams = list(zip(*(x.tolist() for x in _grams(hashes)), strict=True))
        rows += [(h, check, number, at) for at, (h, check) in enumerate(grams)]
        sizes.append(len(grams))
    if words > TEMPLATE_WORDS:
        raise ValueError(f"templates of more than {TEMPLATE_WORDS} words")
    return spark.createDataFrame(rows, "hash long, template_check long, template int, at int"), sizes


def _rolled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All k-grams, and for each document a row of its length with the id in place of a check."""
    for batch in chunks(batches):
        hashes, first = _word_hashes(*flat_text(batch.column("text")))
        sizes = np.diff(first)
        row = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(hashes)) - first[:-1][row]
        gram, check = _grams(hashes)
        fits = np.flatnonzero((place <= sizes[row] - GRAM)[: len(gram)])
        key = batch.column("key").to_numpy()
        many = len(sizes)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(key[row[fits]]),
                pa.array(place[fits].astype(np.int32)),
                pa.array(gram[fits]),
                pa.array(check[fits]),
            ],
            names=["key", "place", "hash", "check"],
        )
        yield pa.RecordBatch.from_arrays(
            [pa.array(key), pa.array(sizes.astype(np.int32)), pa.array(np.full(many, _END)), batch.column("doc_id")],
            names=["key", "place", "hash", "check"],
        )


def _chain(matches: list[tuple[int, int]]) -> int:
    """Most matches that go forward in both texts."""
    tails: list[int] = []
    for _, at in sorted(matches, key=lambda m: (m[0], -m[1])):
        i = bisect_left(tails, at)
        tails[i : i + 1] = [at]
    return len(tails)


def _spans(diagonals: list[dict], size: int, share: float, slack: int) -> list[tuple[list[tuple[int, int]], float]]:
    """Verified spans of one template: matches by place in document and template, and the share covered."""
    found, group = [], []
    for d in sorted(diagonals, key=lambda d: d["diagonal"]) + [None]:
        if group and (d is None or d["diagonal"] - group[-1]["diagonal"] > slack):
            if sum(len(x["at"]) for x in group) >= share * size:
                matches = [(x["diagonal"] + at, at) for x in group for at in x["at"]]
                covered = _chain(matches) / size
                if covered >= share:
                    found.append((matches, covered))
            group = []
        group.append(d)
    return found


def _told_apart(spans: list[tuple[str, int, list[tuple[int, int]], float]], share: float) -> list[dict]:
    """Of spans with label and template size: those that cover enough without the places of better ones."""
    taken: dict[int, str] = {}
    kept = []
    for label, size, matches, covered in sorted(spans, key=lambda s: (-s[3], -s[1], s[0], min(s[2]))):
        own = [m for m in matches if taken.get(m[0], label) == label]
        if len(own) < len(matches) and _chain(own) < share * size:
            continue
        for place, _ in own:
            taken[place] = label
        kept.append({"label": label, "first": min(matches)[0], "last": max(matches)[0] + GRAM - 1, "covered": covered})
    return kept


RESULT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, spans array<struct<label:string,first:int,last:int,covered:double>>"
)


def scan(
    docs: DataFrame,
    templates: tuple[Template, ...] = TEMPLATES,
    share: float = SHARE,
    slack: int = SLACK,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row of every document: places of whole phrases, labels, and the best share of a template."""
    grams, sizes = _template_grams(docs.sparkSession, templates)
    rolled = docs.select(
        F.monotonically_increasing_id().alias("key"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")
    ).mapInArrow(_rolled, "key long, place int, hash long, check long")
    # a bounded table: TEMPLATE_WORDS
    voted = rolled.join(F.broadcast(grams), "hash").filter(
        (F.col("template") == -1) | (F.col("check") == F.col("template_check"))
    )
    votes = voted.groupBy("key", "template", (F.col("place") - F.col("at")).alias("diagonal")).agg(
        F.sort_array(F.collect_list("at")).alias("at"), F.max("check").alias("check")
    )
    end = F.col("template") == -1
    by_doc = votes.groupBy("key").agg(
        F.max(F.when(end, F.col("check"))).alias("doc_id"),
        F.max(F.when(end, F.col("diagonal"))).alias("n_words"),
        F.collect_list(F.when(~end, F.struct("template", "diagonal", "at"))).alias("votes"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                _document(i, n, votes, templates, sizes, share, slack)
                for i, n, votes in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_words", "votes")), strict=True)
            ]
            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)

    return by_doc.select("doc_id", "n_words", "votes").mapInArrow(run, RESULT)


_SCHEMA = pa.schema(
    [
        *((c, pa.int64()) for c in ("doc_id", "n_words", "n_base", "first_word", "last_word")),
        ("base_labels", pa.string()),
        ("labels", pa.string()),
        ("score", pa.float64()),
        (
            "spans",
            pa.list_(
                pa.struct([("label", pa.string()), ("first", pa.int32()), ("last", pa.int32()), ("covered", pa.float64())])
            ),
        ),
    ]
)


def _document(doc_id, n_words, votes, templates, sizes, share, slack) -> dict:
    by_template: dict[int, list[dict]] = {}
    for v in votes:
        by_template.setdefault(v["template"], []).append(v)
    base, places, spans, texts = set(), [], [], []
    for number, diagonals in sorted(by_template.items()):
        template, size = templates[number], sizes[number]
        if template.whole:
            whole = sorted(d["diagonal"] for d in diagonals if len(d["at"]) == size)
            places += whole
            spans += [{"label": template.label, "first": a, "last": a + size + GRAM - 2, "covered": 1.0} for a in whole]
            base |= {template.label} if whole else set()
        else:
            texts += [(template.label, size, *found) for found in _spans(diagonals, size, share, slack)]
    spans += _told_apart(texts, share)
    labels = {s["label"] for s in spans}
    return {
        "doc_id": doc_id,
        "n_words": n_words,
        "n_base": len(places),
        "first_word": min(places, default=None),
        "last_word": max(places, default=None),
        "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(base | labels)),
        "score": max((s["covered"] for s in spans), default=0.0),
        "spans": sorted(spans, key=lambda s: (s["first"], s["label"])),
    }
