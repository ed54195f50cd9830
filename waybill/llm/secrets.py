"""Secret scans with a ledger of blobs.

A text is addressed by its digest. The ledger holds, for every blob and version of the
rules, the spans that were found. A run scans only blobs that the ledger lacks for the
present rules, each once however many paths and versions hold it, appends what it found and
joins the ledger back to all rows. Changed rules have another version, so they scan anew and
leave earlier findings as they are.

Blobs travel packed. Copies are combined before the shuffle, so a text that a third of all
rows share is one row from each task. Null text is the empty blob; it has no findings and
every row gets a result; repeated rows share their blob. Offsets are code points, end
exclusive. Columns of docs with the names of results are replaced. One run writes a ledger at
a time; a blob that two runs have written is read once.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import chunks, flat_text


@dataclass(frozen=True)
class Rule:
    """A pattern, and a group of it that needs some length; hints are parts of every match, in lower case."""

    kind: str
    pattern: str
    group: int
    least: int
    hints: tuple[str, ...] = ()


# The kinds and patterns of the base findings.
BASE = (
    Rule(
        "assign",
        r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
        ("passw", "secret", "token", "apikey", "api_key"),
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, ("akia",)),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
#: Findings beyond the base: keys and tokens that are known by their form.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", 0, 1, ("private key-----",)),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1, ("eyj",)),
    Rule("access_token", r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{20,})", 0, 1, ("gh", "xox")),
)
RULES = BASE + MORE
SPANS = "array<struct<kind:string,start:int,end:int>>"
LEDGER = f"blob binary, rules string, spans {SPANS}"


def version(rules: tuple[Rule, ...]) -> str:
    """Another version for any other rules."""
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


def _spans(rules: list[tuple[Rule, re.Pattern]], raw: bytes, long_hex: bool) -> list[dict]:
    low, found, text = raw.lower(), [], None
    for place, (rule, pattern) in enumerate(rules):
        hinted = any(h.encode() in low for h in rule.hints) if rule.hints else rule.kind != "hex" or long_hex
        if hinted:
            text = raw.decode() if text is None else text
            found += [
                (m.start(), place, m.end()) for m in pattern.finditer(text) if len(m[rule.group]) >= rule.least
            ]
    return [{"kind": rules[p][0].kind, "start": a, "end": b} for a, p, b in sorted(found)]


def _long_hex(data: np.ndarray, offsets: np.ndarray, least: int) -> np.ndarray:
    """Texts with a run of at least so many of 0-9a-f; a run over two texts names them needlessly."""
    table = np.zeros(256, dtype=bool)
    table[list(b"0123456789abcdef")] = True
    gaps = np.append(np.append(-1, np.flatnonzero(~table[data])), len(data))
    runs = np.flatnonzero(np.diff(gaps) > least)
    marked = np.zeros(len(offsets), dtype=bool)
    for a, b in zip(gaps[runs] + 1, gaps[runs + 1], strict=True):
        marked[np.searchsorted(offsets, a, "right") - 1 : np.searchsorted(offsets, b)] = True
    return marked


def find(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``blob, rules, spans`` of packed texts ``blob, packed``."""
    name, hex_least = version(rules), min((r.least for r in rules if r.kind == "hex"), default=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled, unpack = [(r, re.compile(r.pattern)) for r in rules], zstandard.ZstdDecompressor()
        for batch in batches:
            blob, packed = batch.column("blob"), batch.column("packed")
            for a in range(0, batch.num_rows, 256):
                raw = [unpack.decompress(x.as_py()) for x in packed.slice(a, 256)]
                marked = _long_hex(*flat_text(pa.array(raw, type=pa.large_binary())), hex_least)
                spans = [_spans(compiled, x, bool(m)) for x, m in zip(raw, marked, strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [
                        blob.slice(a, 256),
                        pa.array([name] * len(raw)),
                        pa.array(
                            spans,
                            type=pa.list_(
                                pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
                            ),
                        ),
                    ],
                    names=["blob", "rules", "spans"],
                )

    return blobs.select("blob", "packed").mapInArrow(run, LEDGER)


def address(text: Column) -> Column:
    """The digest that names a text."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _packed(docs: DataFrame, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in chunks(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("blob"), pa.array([pack.compress((x.as_py() or "").encode()) for x in batch.column("text")], type=pa.binary())],
                names=["blob", "packed"],
            )

    return docs.select(address(F.col(text)).alias("blob"), F.col(text).alias("text")).mapInArrow(
        run, "blob binary, packed binary"
    )


def read_ledger(spark, ledger: str, rules: tuple[Rule, ...]) -> DataFrame:
    """``blob, spans`` known for the rules; a ledger that is not there yet is empty."""
    try:
        rows = spark.read.schema(LEDGER).parquet(f"{ledger}/*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], LEDGER)
    known = rows.filter(F.col("rules") == version(rules))
    return known.groupBy("blob").agg(F.first("spans").alias("spans"))


def scan(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """Brings the ledger folder up to date and gives all columns, ``blob`` and ``spans`` of every row."""
    spark = docs.sparkSession
    known = read_ledger(spark, ledger, rules).select("blob")
    unseen = _packed(docs, text).join(known, "blob", "left_anti")
    once = unseen.groupBy("blob").agg(F.first("packed").alias("packed"))
    find(once, rules).write.parquet(f"{ledger}/{uuid.uuid4().hex}")
    rows = docs.drop("blob", "spans").withColumn("blob", address(F.col(text)))
    return rows.join(read_ledger(spark, ledger, rules), "blob")


def _masked(texts: pd.Series, starts: pd.Series, ends: pd.Series, masks: pd.Series) -> pd.Series:
    made = []
    for text, begin, end, mask in zip(texts, starts, ends, masks, strict=True):
        if text is not None:
            parts, at = [], 0
            for a, b in sorted(zip(begin, end, strict=True)):
                parts += [text[at:a], mask * (b - max(a, at))]
                at = max(at, b)
            text = "".join([*parts, text[at:]])
        made.append(text)
    return pd.Series(made, dtype=object)


def masked(text: Column, spans: Column, mask: str = "*") -> Column:
    """The text with every character of its spans replaced, in one walk along the text."""
    return F.pandas_udf(_masked, "string")(text, spans["start"], spans["end"], F.lit(mask))
