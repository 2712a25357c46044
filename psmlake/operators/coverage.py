"""Sequence coverage: where a protein's peptides stand, and how much of it they cover."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from psmlake.operators import lineage
from psmlake.operators.annotate import keep_mode

#: Hits of a peptide that are marked one by one; more are marked in one pass over the sequence.
FEW = 16
#: From so many peptides on, they are sought all at once by their first SEED letters, in BLOCK places at a time.
MANY = 24
SEED = 8
BLOCK = 1 << 16


def normalised_name(name: Column) -> Column:
    """Lower case, no blanks around, no FASTA extension, no closing `_rescored`."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(name)), r"\.(fasta|faa|fa)$", ""), "_rescored$", "")


def hits(sequence: str, core: str, before: str | None, after: str | None) -> Iterator[int]:
    """Starts (0-based) of all hits of the core, overlapping ones too, whose neighbours are the flanks; a null flank fits anything, the sequence's ends too."""
    at = sequence.find(core) if core else -1
    while at >= 0:
        end = at + len(core)
        if (before is None or (at > 0 and sequence[at - 1] == before)) and (after is None or sequence[end : end + 1] == after):
            yield at
        at = sequence.find(core, at + 1)


def flanked(peptide: str, compat: bool) -> tuple[str | None, str, str | None]:
    """What functions.peptide.flanks() says of one peptide, in upper case."""
    if compat:
        parts = peptide.split(".")
        before, core, after = parts if len(parts) == 3 else (None, peptide, None)
    else:
        start, end = re.match(r"([A-Za-z\-]?)\.", peptide), re.search(r"\.([A-Za-z\-]?)$", peptide)
        before, after = (m[1] if m else None for m in (start, end))
        inner = re.sub(r"\.[A-Z\-]$", "", re.sub(r"^[A-Z\-]\.", "", peptide.strip(" ")))
        core = re.sub("[^A-Z]", "", inner.upper())
    known = lambda x: x.upper() if x and x != "-" else None
    return known(before), core.upper(), known(after)


def overlaps_itself(core: str) -> bool:
    """Whether two hits of the core may overlap: it begins as it ends."""
    return any(core.startswith(core[k:]) for k in range(1, len(core)))


@lru_cache(1 << 16)
def _read(peptide: str, compat: bool) -> tuple[str | None, str, str | None, bytes | None, bytes]:
    """flanked(), the core as bytes where every hit may be replaced at once, and what replaces it."""
    before, core, after = flanked(peptide, compat)
    plain = core.isascii() and before is None and after is None and core != "" and not overlaps_itself(core)
    return before, core, after, core.encode() if plain else None, b"\x01" * len(core)


def runs(batch: pa.RecordBatch, names: list[str]) -> Iterator[tuple[int, int]]:
    """(start, end) of the runs of rows that have the same values of `names`: compared as columns, not row by row."""
    n = batch.num_rows
    new = np.zeros(max(n - 1, 0), bool)
    for column in map(batch.column, names) if n > 1 else ():
        x, y = column.slice(0, n - 1), column.slice(1)
        new |= pc.fill_null(pc.not_equal(x, y), False).to_numpy(zero_copy_only=False) | (x.is_null().to_numpy(zero_copy_only=False) != y.is_null().to_numpy(zero_copy_only=False))
    edges = [0, *(np.flatnonzero(new) + 1).tolist(), n] if n else [0]
    return zip(edges[:-1], edges[1:], strict=True)


def mark_all(text: bytes, cores: list[bytes], mark: bytearray) -> None:
    """Mark all places of all cores, overlapping ones too: work in proportion to the text, whatever the number of cores."""
    groups = defaultdict(list)
    for core in cores:
        groups[min(len(core), SEED)].append(core)
    seeds, longer, tables = {}, defaultdict(list), {}
    for k, own in groups.items():
        seeds[k] = np.unique(np.array([int.from_bytes(c[:k], "big") for c in own], np.uint64))
        tables[k] = np.zeros(1 << 16, bool)
        tables[k][_slot(seeds[k])] = True
    for core in groups.get(SEED, ()):
        longer[int.from_bytes(core[:SEED], "big")].append((core, b"\x01" * len(core)))
    for begin in range(0, len(text), BLOCK):
        letters = np.frombuffer(text[begin : begin + BLOCK + SEED - 1], np.uint8)
        steps, code = np.zeros(len(letters) + 1, np.int32), letters.astype(np.uint64)
        for k in range(1, SEED + 1):
            if k > 1:
                code = (code[:-1] << np.uint64(8)) | letters[k - 1 :]
            if not len(code):
                break
            if k not in seeds:
                continue
            here = code[:BLOCK]
            at = np.flatnonzero(tables[k][_slot(here)])
            value = here[at]
            at = at[seeds[k][np.minimum(np.searchsorted(seeds[k], value), len(seeds[k]) - 1)] == value]
            if k < SEED:
                steps[at] += 1
                steps[at + k] -= 1
                continue
            for i, v in zip((at + begin).tolist(), here[at].tolist(), strict=True):
                for core, cover in longer[v]:
                    if text.startswith(core, i):
                        mark[i : i + len(core)] = cover
        own = np.frombuffer(mark, np.uint8)[begin : begin + len(letters)]
        np.bitwise_or(own, np.cumsum(steps[:-1]) > 0, out=own)


def _slot(codes: np.ndarray) -> np.ndarray:
    return (codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)


class Proteins:
    """Reads rows in order of their keys, each key's sequence before its peptides, and gives what each key's samples cover."""

    def __init__(self, names: list[str], schema: pa.Schema, compat: bool):
        self.names, self.schema, self.compat = names, schema, compat
        self.key, self.sequence, self.out = None, None, []

    def begin(self, key: tuple, sequence: str | None) -> None:
        self.key, self.sequence, self.peptides, self.marks = key, sequence, defaultdict(set), {}
        self.plain = sequence.encode() if sequence and sequence.isascii() and "\x01" not in sequence else None

    def end(self) -> None:
        if self.sequence:
            n = len(self.sequence)
            for sample, peptides in self.peptides.items():
                self.out.append((*self.key, sample, len(peptides), 100.0 * self.marks[sample].count(1) / n))

    def found(self, sample: object, peptides: Iterable[str]) -> None:
        """Mark what peptides of one sample cover."""
        own = self.peptides[sample]
        mark = self.marks.get(sample)
        if mark is None:
            mark = self.marks[sample] = bytearray(len(self.sequence))
        text, new = self.plain, set(peptides) - own
        own |= new
        if text is not None and len(new) >= MANY:
            read = {peptide: _read(peptide, self.compat) for peptide in new}
            bare = {p: core.encode() for p, (before, core, after, *_) in read.items() if core and core.isascii() and before is None and after is None}
            mark_all(text, list(bare.values()), mark)
            new = [p for p in read if p not in bare]
        for peptide in new:
            before, core, after, plain, cover = _read(peptide, self.compat)
            if plain is None or text is None:
                for at in hits(self.sequence, core, before, after):
                    mark[at : at + len(core)] = cover
            elif text.count(plain) > FEW:  # all hits in one pass
                np.bitwise_or(np.frombuffer(mark, np.uint8), np.frombuffer(text.replace(plain, cover), np.uint8) == 1, out=np.frombuffer(mark, np.uint8))
            else:
                at, n = text.find(plain), len(plain)
                while at >= 0:
                    mark[at : at + n] = cover
                    at = text.find(plain, at + n)

    def flushed(self) -> pa.RecordBatch:
        columns = list(zip(*self.out, strict=True)) or [()] * len(self.schema)
        self.out = []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, self.schema.types, strict=True)], schema=self.schema)

    def read(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())  # gives back what it once held; a worker lives on
        for batch in batches:
            body = batch.column("body").to_numpy(zero_copy_only=False)
            for start, end in runs(batch, [*self.names, "sample", "is_peptide"]):
                key = tuple(batch.column(c)[start].as_py() for c in self.names)
                if key != self.key:
                    self.end()
                    self.begin(key, None)
                if batch.column("is_peptide")[start].as_py():
                    if self.sequence:
                        self.found(batch.column("sample")[start].as_py(), body[start:end])
                elif not self.sequence:
                    self.begin(key, next((x for x in body[start:end] if x), None))
            yield self.flushed()
        self.end()
        yield self.flushed()
        lineage.give_back()


def coverage(annotated: DataFrame, proteins: DataFrame, mode: str = "all_matches", min_num_pep: int = 2, compat: bool = False, databases: DataFrame | None = None) -> DataFrame:
    """(Protein, sample, num_pep, coverage in percent) from flanked peptides with a positive intensity.

    `proteins`: Protein, Sequence; letters of any case; of several rows with one id any one counts.  Proteins without a sequence are left out.  compat: peptides with a mass in their text cover nothing.
    `databases` (sample, database): proteins have a database too, and a sample's peptides are sought in its own; samples without one are left out.
    Sequences and peptides cross one exchange together, by protein; in a task each sequence stands before its peptides, which are marked on it as they
    come (tasks grow in number with the files, so that none reads more of larger ones), so a protein of any number of peptides holds no more than its sequence, a mark for each residue and sample, and the peptides' names.
    """
    rows = keep_mode(annotated.where("intensity > 0"), mode).select("Protein", "sample", "PeptideFlanked").where("PeptideFlanked IS NOT NULL AND Protein IS NOT NULL")
    keys = ["Protein"]
    if databases is not None:
        rows, keys = rows.join(sample_databases(rows.select("sample").distinct(), databases), "sample"), ["database", "Protein"]
    sample = rows.schema["sample"].dataType
    sequences = proteins.select(*keys, F.lit(None).cast(sample).alias("sample"), F.upper("Sequence").alias("body"), F.lit(False).alias("is_peptide"))  # empty ones go in the task: a filter here would work out every sequence twice
    both = sequences.unionByName(rows.select(*keys, "sample", F.col("PeptideFlanked").alias("body"), F.lit(True).alias("is_peptide")))
    parts = lineage.parts_for(both)
    usual = int(both.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    together = (both.repartition(parts, *keys) if parts > usual else both.repartition(*keys)).sortWithinPartitions(*keys, "is_peptide")
    kinds = T.StructType([*[both.schema[c] for c in keys], T.StructField("sample", sample), T.StructField("num_pep", T.LongType()), T.StructField("coverage", T.DoubleType())])
    out = together.mapInArrow(lambda batches, k=to_arrow_schema(kinds): Proteins(keys, k, compat).read(batches), kinds).select("Protein", "sample", "num_pep", "coverage")
    return out.where(F.col("num_pep") >= min_num_pep) if min_num_pep > 1 else out


def sample_databases(samples: DataFrame, databases: DataFrame) -> DataFrame:
    """(sample, database) by normalised names; samples without a database are left out."""
    a = samples.select("sample", normalised_name(F.col("sample")).alias("__name"))
    b = databases.select("database", normalised_name(F.col("sample")).alias("__name"))
    return a.join(b, "__name").drop("__name")


#: Names and endings of a foreign table's columns that are no samples.
RESERVED = ("Peptide", "PeptideFlanked", "Protein", "Unique", "Shared", "Gene", "Function", "nested")
NOT_SAMPLES = ("fdrstats", "stats", "pvalue", "qvalue", "score", "rank", "count", "total", "avg", "mean", "median", "std", "var")


def guessed_samples(df: DataFrame, rule: str = "reserved") -> list[str]:
    """Sample columns of a foreign wide table.

    reserved: all columns but the known ones; numeric: of those, not named like a statistic and numbers in more than half of
    the rows; varied: of those that are numeric, with a value other than 0 and 1.
    """
    names = [c for c in df.columns if c not in RESERVED]
    if rule == "reserved" or not names:
        return names
    named = [c for c in names if not re.search(rf"_({'|'.join(NOT_SAMPLES)})$", c, re.IGNORECASE)]
    value = {c: F.col(f"`{c}`").try_cast("double") for c in named}
    if not named:
        return []
    counts = df.agg(F.count("*").alias("__n"), *[F.count(v).alias(f"{c}__n") for c, v in value.items()], *[F.count_if(~v.isin(0.0, 1.0)).alias(f"{c}__v") for c, v in value.items()]).first()
    numeric = [c for c in named if counts[f"{c}__n"] > 0.5 * counts["__n"]]
    return numeric if rule == "numeric" else [c for c in numeric if counts[f"{c}__v"]]
