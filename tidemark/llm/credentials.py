"""Secret scans: what looks like a credential is judged by who else has it.

Every text is searched for candidates: values assigned to a name such as ``password``, access key ids, long hexadecimal
runs, and opaque runs that no pattern names. Each candidate's value is hashed, and the hashes are counted over the whole
corpus by distinct owners and distinct repositories. A value that many owners or repositories hold is an example that was copied
around; one that a few owners hold to themselves, and whose characters look drawn at random, is taken for live. An opaque run
counts as a finding only by that evidence: it is owner-specific and looks live, or it is the bare reuse of a value that is live and
assigned elsewhere. Findings of the three patterns always stay and only get their label.

Labels: ``copied`` (more than max_owners owners or max_repositories repositories), ``live`` (owner-specific, looks drawn at
random), ``weak`` (owner-specific, but a word, a placeholder or a short number).

Plan: one pass over the texts leaves a small row per document, written once. Its candidates are made distinct by
(value, owner, repository), counted by value, and joined back; values that very many rows hold travel by broadcast, at most
1 / HOT_SHARE of them. No text is shuffled.

Defined cases: a null text is empty; documents with equal or null ids are rows of their own; a null owner or repository
is one owner or repository like any other; empty tables give no rows; columns that aren't named are ignored, and those to be
kept travel in one struct, so that their names can't clash.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tidemark.llm.common import mark_hot, row_slices, split_join, stored
from tidemark.llm.words import _runs, raw

# The kinds in their order, and the patterns that define the first three.
KINDS = ("assign", "access", "hex", "opaque")
ASSIGN, ACCESS, HEX, OPAQUE = range(4)
_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
#: Any text with an assignment has this; RE2 looks for it in all rows at once.
_ASSIGN_HINT = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]"""
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST, OPAQUE_LEAST, REUSED_LEAST = 6, 20, 24, 20, 12
_PLACEHOLDER = re.compile(rb"example|changeme|placeholder|dummy|sample|your|xxxx|redacted|test|0123456|1234567|abcdef", re.IGNORECASE)


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_UPPER, _LOWER, _DIGIT = _table(bytes(range(65, 91))), _table(bytes(range(97, 123))), _table(bytes(range(48, 58)))
_HEX = _DIGIT | _table(b"abcdef")
_OPAQUE = _UPPER | _LOWER | _DIGIT | _table(b"+/_=-.")

CANDIDATE = "kind int, start long, end long, value binary, random boolean, strong boolean"


def entropy(value: bytes) -> float:
    """Bits a character, from the characters' own frequencies."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def looks_random(value: bytes) -> bool:
    """Whether value may have been drawn at random: long enough, with a digit, mixed and without a placeholder's words."""
    return len(value) >= 8 and any(48 <= c < 58 for c in value) and entropy(value) >= 2.5 and not _PLACEHOLDER.search(value)


def looks_strong(value: bytes) -> bool:
    """The evidence asked of a run that no pattern names: upper and lower case, digits, and 3.5 bits a character."""
    kinds = {"u" if 65 <= c < 91 else "l" if 97 <= c < 123 else "d" if 48 <= c < 58 else "" for c in value}
    return len(value) >= OPAQUE_LEAST and {"u", "l", "d"} <= kinds and value[:1] != b"/" and b"//" not in value and entropy(value) >= 3.5 and looks_random(value)


@dataclass
class _Found:
    kind: int
    row: int
    start: int
    end: int
    value: bytes


def _base(column: pa.Array, data: np.ndarray, offsets: np.ndarray) -> list[_Found]:
    """Matches of the three patterns, as byte ranges of data."""
    found = []
    whole = data.tobytes()
    hinted = pc.fill_null(pc.match_substring_regex(column, _ASSIGN_HINT), False).to_numpy(zero_copy_only=False)
    for row in np.flatnonzero(hinted).tolist():
        a, b = int(offsets[row]), int(offsets[row + 1])
        found += [_Found(ASSIGN, row, m.start(), m.end(), m[2]) for m in _ASSIGN.finditer(whole, a, b) if len(m[2]) >= ASSIGN_LEAST]
    named = pc.fill_null(pc.match_substring(column, "AKIA"), False).to_numpy(zero_copy_only=False)
    for row in np.flatnonzero(named).tolist():
        a, b = int(offsets[row]), int(offsets[row + 1])
        found += [_Found(ACCESS, row, m.start(), m.end(), m[0]) for m in _ACCESS.finditer(whole, a, b) if len(m[0]) >= ACCESS_LEAST]
    start, end = _runs(_HEX[data], offsets)
    long = end - start >= HEX_LEAST
    for a, b, row in zip(start[long].tolist(), end[long].tolist(), (np.searchsorted(offsets, start[long], side="right") - 1).tolist(), strict=True):
        found.append(_Found(HEX, row, a, b, whole[a:b]))
    return found


def _opaque(data: np.ndarray, offsets: np.ndarray, base: list[_Found]) -> list[_Found]:
    """Runs of the characters of keys, with letters and digits, that meet no finding of the patterns."""
    start, end = _runs(_OPAQUE[data], offsets)
    long = end - start >= REUSED_LEAST
    start, end = start[long], end[long]
    digits, letters = (np.concatenate([[0], np.cumsum(t[data])]) for t in (_DIGIT, _UPPER | _LOWER))
    mixed = (digits[end] > digits[start]) & (letters[end] > letters[start])
    start, end = start[mixed], end[mixed]
    taken = np.zeros(len(data) + 1, dtype=np.int32)
    for x in base:
        taken[x.start] += 1
        taken[x.end] -= 1
    held = np.concatenate([[0], np.cumsum(np.cumsum(taken[:-1]) > 0)])
    free = held[end] == held[start]
    found = []
    for a, b, row in zip(start[free].tolist(), end[free].tolist(), (np.searchsorted(offsets, start[free], side="right") - 1).tolist(), strict=True):
        value = data[a:b].tobytes()
        whole = len(value)
        value = value.rstrip(b".-")
        b -= whole - len(value)
        stripped = value.lstrip(b".-")
        a += len(value) - len(stripped)
        if len(stripped) >= REUSED_LEAST:
            found.append(_Found(OPAQUE, row, a, b, stripped))
    return found


def scan(docs: DataFrame, text: str, owner: Column, repository: Column, keep: list[str]) -> DataFrame:
    """A row per document, written once: (row, kept, owner, repository, base_sha256, found), found holding every candidate.

    Offsets count code points, ends exclusive.
    """
    source = docs.select(F.struct(*keep).alias("_row"), owner.cast("string").alias("_owner"), repository.cast("string").alias("_repository"), F.col(text).alias("_text"))
    schema = StructType([StructField("row", LongType()), *source.schema.fields[:3], StructField("base_sha256", StringType()), StructField("found", ArrayType(StructType.fromDDL(CANDIDATE)))])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for rows in row_slices(batches, "_text", 4 << 20):
            column = rows["_text"].combine_chunks()
            data, offsets = raw(column)
            base = _base(column, data, offsets)
            every = base + _opaque(data, offsets, base)
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            found: dict[int, list[dict]] = {}
            for x in every:
                at = points[offsets[x.row]]
                value = x.value.strip(b".-") if x.kind in (ASSIGN, OPAQUE) else x.value
                found.setdefault(x.row, []).append({"kind": x.kind, "start": int(points[x.start] - at), "end": int(points[x.end] - at),
                                                    "value": hashlib.sha256(value).digest()[:16], "random": looks_random(value), "strong": looks_strong(value)})
            digest, empty = [], hashlib.sha256(b"").hexdigest()
            for i in range(rows.num_rows):
                spans = sorted((f["start"], f["kind"], f["end"]) for f in found.get(i, ()) if f["kind"] != OPAQUE)
                digest.append(hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest() if spans else empty)
            made = rows.select(["_row", "_owner", "_repository"]).add_column(0, "row", pa.array(np.arange(number, number + rows.num_rows), pa.int64()))
            made = made.append_column("base_sha256", pa.array(digest, pa.string()))
            kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.binary()), ("random", pa.bool_()), ("strong", pa.bool_())]))
            made = made.append_column("found", pa.array([found.get(i, []) for i in range(rows.num_rows)], kind))
            number += rows.num_rows
            yield from made.combine_chunks().to_batches()

    return stored(source.mapInArrow(search, schema), "credentials")


def owners(scanned: DataFrame) -> DataFrame:
    """(value, n, owners, repositories, assigned): of every candidate value, over the whole corpus.

    n counts occurrences; assigned says whether it stands behind a name somewhere. A repository belongs to its owner, so equal names
    under two owners are two.
    """
    each = scanned.select("_owner", "_repository", F.explode("found").alias("f")).select("_owner", "_repository", F.col("f.value").alias("value"), (F.col("f.kind") != OPAQUE).alias("named"))
    by_repository = each.groupBy("value", "_owner", "_repository").agg(F.count("*").alias("n"), F.max("named").alias("named"))
    by_owner = by_repository.groupBy("value", "_owner").agg(F.sum("n").alias("n"), F.count("*").alias("repositories"), F.max("named").alias("named"))
    return by_owner.groupBy("value").agg(F.sum("n").alias("n"), F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.max("named").alias("assigned"))


def label(max_owners: int, max_repositories: int) -> Column:
    """The label of a candidate joined with its value's counts."""
    wide = (F.col("owners") > max_owners) | (F.col("repositories") > max_repositories)
    return F.when(wide, "copied").when(F.col("random"), "live").otherwise("weak")


def findings(scanned: DataFrame, max_owners: int = 2, max_repositories: int = 4) -> DataFrame:
    """(row, kind, start, end, value, owners, repositories, label): the candidates that count.

    Those of the patterns all do. An opaque run does if it is live and strong, or a live value assigned elsewhere.
    """
    counted = mark_hot(owners(scanned), "n").drop("n")
    each = scanned.select("row", F.explode("found").alias("f")).select("row", "f.*")
    met = split_join(each, counted, ["value"]).withColumn("label", label(max_owners, max_repositories))
    counts = (F.col("kind") != OPAQUE) | ((F.col("label") == "live") & (F.col("strong") | F.col("assigned")))
    return met.where(counts).select("row", "kind", "start", "end", "value", "owners", "repositories", "label")


def by_document(scanned: DataFrame, found: DataFrame) -> DataFrame:
    """(kept columns, n_assign, n_access, n_hex, n_opaque, n_live, n_copied, base_sha256, spans) of every document.

    spans joins kind:start:end of all findings with commas, by start, kind as listed, end. The findings of a document
    are as many as its text has room for.
    """
    name = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    per_row = found.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", name.alias("name"), "label"))).alias("all"))
    met = scanned.drop("_owner", "_repository", "found").join(per_row, "row", "left").withColumn("all", F.coalesce("all", F.array().cast(per_row.schema["all"].dataType)))

    def how_many(field: str, value: int | str) -> Column:
        return F.size(F.filter("all", lambda x: x[field] == value)).cast("long")

    size = [how_many("kind", k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    labels = [how_many("label", w).alias(f"n_{w}") for w in ("live", "copied")]
    spans = F.array_join(F.transform("all", lambda x: F.concat_ws(":", x["name"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    return met.select("_row.*", *size, *labels, "base_sha256", spans.alias("spans"))
