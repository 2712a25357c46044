"""Language identification by Bayesian fusion of text, declared language, address suffix and host.

The text's likelihood comes from byte trigrams, hashed to `SLOTS` slots, of a language model fitted on a bounded sample of
labelled documents, beside a flat model for anything else (`und`).  Runs of two or more symbols, up to three of each, which speech has few of, count `NOISE` against every
language.  At most `STRENGTH` trigrams' worth of evidence counts, as trigrams of one text are not independent.  What a declared language and an address suffix say is estimated from the corpus: grouped sums of
the texts' own posteriors give P(declared | language) and P(suffix | language).  A host's prior is smoothed
towards its parent domain's, that towards the whole corpus; a page's own vote is left out of its host's.

`identify` takes what evidence it is given; `spoken`, the filter, leaves a row's own label out, so that it cannot confirm itself.

Defined results: a null or empty text, or one under three bytes, has no text evidence; null or empty declared languages, suffixes and hosts add none; a row whose best language
is `und` or below `accept` is not accepted; ids may be null or repeat; texts of any length are read whole; more than `max_languages` labels in the sample raise ValueError; an empty table gives an empty table; other columns are kept, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import MARK, bounded_batches, trim, written
from .text_kernels import LOWER, slices

SLOTS = 1 << 16
STRENGTH = 60
SMOOTH = 4.0
FEW_VOTES = 1_000_000
NOISE, RUN = 20.0, 3
NO_TEXT = re.compile(r"(?is)<(script|style|head)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")
BLANK = np.zeros(256, bool)
BLANK[:65] = True
BLANK[91:97] = True
BLANK[123:128] = True
SYMBOL = BLANK.copy()
SYMBOL[:33] = False
SYMBOL[48:58] = False
SYMBOL[127] = False


@dataclass
class TrigramModel:
    languages: list[str]
    log_chance: np.ndarray  # language x slot

    def evidence(self, texts: pa.Array) -> np.ndarray:
        """Log-likelihood of each text under each language and, last, the flat model; at most STRENGTH trigrams count."""
        out = np.zeros((len(texts), len(self.languages) + 1))
        for first, data, offsets in slices(texts):
            slot, ends = trigrams(data, offsets)
            many = np.diff(ends)
            some = np.flatnonzero(many)
            if not len(some):
                continue
            noise = symbols(data, offsets)[some]
            all_ = many[some] + noise
            scale = np.minimum(all_, STRENGTH) / all_
            for k in range(len(self.languages)):
                out[first + some, k] = (np.add.reduceat(self.log_chance[k][slot], ends[some]) - NOISE * noise) * scale
            out[first + some, -1] = -np.log(SLOTS) * many[some] * scale
        return out


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the trigrams that hold a letter, and where each row's begin.  Bytes that are no letters count as one blank."""
    b = LOWER[data].astype(np.uint32)
    b[BLANK[data]] = 32
    if len(b) < 3:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data))
    good = (left[: len(code)] >= 3) & (code != 0x202020)
    at = np.flatnonzero(good)
    return ((code[at] * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64), np.searchsorted(at, offsets)


def symbols(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """By row: how many symbols stand in runs of two or more, up to RUN of each."""
    is_ = SYMBOL[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = is_[1:] != is_[:-1]
    edge[offsets] = True
    begin = np.flatnonzero(edge)
    size = np.diff(begin)
    run = np.flatnonzero(is_[begin[:-1]] & (size >= 2)) if len(data) else np.zeros(0, np.int64)
    row = np.searchsorted(offsets, begin[run], "right") - 1
    return np.bincount(row, np.minimum(size[run], RUN), len(offsets) - 1).astype(np.int64)


def fit(docs: DataFrame, text: str = "text", label: str = "lang", doc_id: str = "doc_id", sample_rows: int = 4000, max_languages: int = 200) -> TrigramModel:
    """Trigram counts of each label over a sample taken in the order of a hash of id and text; whole texts, counted on executors."""
    bounded_batches(docs.sparkSession)
    named = docs.where(F.col(f"`{label}`").isNotNull() & (F.trim(f"`{label}`") != "") & F.col(f"`{text}`").isNotNull())
    order = F.xxhash64(F.col(f"`{doc_id}`"), F.when(F.col(f"`{doc_id}`").isNull(), F.col(f"`{text}`")), F.lit(5))
    ids = named.select(order.alias("h")).orderBy("h").limit(sample_rows).agg(F.max("h")).first()[0]
    sample = named.where(order <= F.lit(ids if ids is not None else 0)).select(F.lower(F.trim(f"`{label}`")).alias("lang"), F.col(f"`{text}`").alias("text"))

    def count(batches):
        for batch in batches:
            langs = np.asarray(batch.column(0).to_pylist())
            total: dict[str, np.ndarray] = {}
            for first, data, offsets in slices(batch.column(1)):
                slot, ends = trigrams(data, offsets)
                own = langs[first : first + len(offsets) - 1]
                each = np.repeat(own, np.diff(ends))
                for l in np.unique(own):
                    total[l] = total.get(l, 0) + np.bincount(slot[each == l], minlength=SLOTS)
            trim()
            yield pa.RecordBatch.from_arrays([pa.array([str(k) for k in total], pa.string()), pa.array([v.astype("<i8").tobytes() for v in total.values()], pa.binary())], names=["lang", "counts"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_buffer(), "<i8") for x in group.column("counts"))
        return pa.table({"lang": group.column("lang")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    got = sample.mapInArrow(count, "lang string, counts binary").groupBy("lang").applyInArrow(add, "lang string, counts binary").limit(max_languages + 1).toArrow().sort_by("lang")
    if len(got) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    counts = [np.frombuffer(x.as_buffer(), "<i8") for x in got.column("counts")]
    chance = [np.log((c + 0.5) / (c.sum() + 0.5 * SLOTS)) for c in counts]
    return TrigramModel(got.column("lang").to_pylist(), np.asarray(chance, np.float32).reshape(len(chance), SLOTS))


def _posterior(log_weights: Column) -> Column:
    top = F.array_max(log_weights)
    chances = F.transform(log_weights, lambda x: F.exp(x - top))
    total = F.aggregate(chances, F.lit(0.0), lambda a, x: a + x)
    return F.transform(chances, lambda x: x / total)


def _sums(df: DataFrame, keys: list[str], own: str, k: int) -> DataFrame:
    return df.groupBy(*keys).agg(F.array(*[F.sum(F.col(own)[i]) for i in range(k)]).alias("votes"))


def identify(df: DataFrame, model: TrigramModel, text: Column, declared: Column | None = None, suffix: Column | None = None, host: Column | None = None, parent: Column | None = None, accept: float = 0.5, prefix: str = "") -> DataFrame:
    """`df` with {prefix}language, {prefix}chance and {prefix}accepted added; its columns keep their names and values."""
    bounded_batches(df.sparkSession)
    names = [F.col(f"`{c}`") for c in df.columns]
    shared = df.sparkSession.sparkContext.broadcast(model)
    k = len(model.languages) + 1
    c = {n: f"{n}{MARK}" for n in ("text", "own", "declared", "suffix", "host", "parent")}

    @F.arrow_udf("array<double>")
    def evidence(texts: pa.Array) -> pa.Array:
        values = shared.value.evidence(texts)
        trim()
        return pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * values.shape[1]), pa.array(values.ravel()))

    key = lambda x: F.nullif(F.lower(F.trim(x)), F.lit("")) if x is not None else F.lit(None).cast("string")
    marked = df.select(*names, evidence(text).alias(c["text"]), key(declared).alias(c["declared"]), key(suffix).alias(c["suffix"]), key(host).alias(c["host"]), key(parent).alias(c["parent"]))
    own = marked.withColumn(c["own"], _posterior(F.col(c["text"])))
    base = own.groupBy(c["declared"], c["suffix"], c["host"], c["parent"]).agg(F.array(*[F.sum(F.col(c["own"])[i]) for i in range(k)]).alias("votes"))


    base = written(base)
    few = base.count() * k <= FEW_VOTES  # numbers that a task may hold: then the tables below are broadcast, else joined by a shuffle
    small = (lambda df: F.broadcast(df)) if few else (lambda df: df)
    everything = base.agg(*[F.sum(F.col("votes")[i]).alias(f"v{i}") for i in range(k)]).first()
    total = np.array([everything[i] or 0.0 for i in range(k)])
    overall = (total + 1.0 / k) / (total.sum() + 1.0)
    prior = F.array(*[F.lit(float(x)) for x in overall])

    def smoothed(votes: Column, towards: Column) -> Column:
        many = F.aggregate(votes, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(votes, towards, lambda v, p: (F.greatest(v, F.lit(0.0)) + SMOOTH * p) / (F.greatest(many, F.lit(0.0)) + SMOOTH))

    def given_language(name: str) -> DataFrame:
        """log P(value | language) by value."""
        sums = _sums(base.where(F.col(c[name]).isNotNull()), [c[name]], "votes", k)
        named = sums.agg(*[F.sum(F.col("votes")[i]).alias(f"v{i}") for i in range(k)], F.count("*").alias("n")).first()
        each = F.array(*[F.lit(float(named[f"v{i}"] or 0.0)) for i in range(k)])
        share = F.aggregate("votes", F.lit(0.0), lambda a, x: a + x) / F.lit(float(max(1e-9, sum(named[f"v{i}"] or 0.0 for i in range(k)))))
        return sums.select(F.col(c[name]).alias(f"{name}_key{MARK}"), F.transform(F.zip_with("votes", each, lambda v, t: (v + SMOOTH * share) / (t + SMOOTH)), lambda x: F.log(x)).alias(f"{name}_log{MARK}"))

    parents = _sums(base.where(F.col(c["host"]).isNotNull()), [c["parent"]], "votes", k)
    hosts = _sums(base.where(F.col(c["host"]).isNotNull()), [c["host"], c["parent"]], "votes", k)
    parents = parents.select(F.col(c["parent"]).alias("p"), F.col("votes").alias("parent_votes"))
    hosts = hosts.join(parents, hosts[c["parent"]].eqNullSafe(parents["p"]), "left")
    hosts = hosts.select(F.col(c["host"]).alias(f"host_key{MARK}"), F.col(c["parent"]).alias(f"host_parent{MARK}"), F.col("votes").alias(f"votes{MARK}"), smoothed(F.col("parent_votes"), prior).alias(f"up{MARK}"))
    out = own
    said = [name for name, column in (("declared", declared), ("suffix", suffix)) if column is not None]
    for name in said:
        out = out.join(small(given_language(name)), F.col(c[name]) == F.col(f"{name}_key{MARK}"), "left")
    out = out.join(small(hosts), (F.col(c["host"]) == F.col(f"host_key{MARK}")) & F.col(c["parent"]).eqNullSafe(F.col(f"host_parent{MARK}")), "left")
    others = F.zip_with(f"votes{MARK}", c["own"], lambda v, p: v - p)
    host_prior = F.coalesce(smoothed(others, F.col(f"up{MARK}")), prior)
    weights = F.zip_with(c["text"], host_prior, lambda t, p: t + F.log(p))
    none = F.array(*[F.lit(0.0)] * k)
    for name in said:
        weights = F.zip_with(weights, F.coalesce(F.col(f"{name}_log{MARK}"), none), lambda a, x: a + x)
    out = out.withColumn(f"all{MARK}", _posterior(weights))
    best = F.array_max(f"all{MARK}")
    which = F.element_at(F.array(*[F.lit(x) for x in [*model.languages, "und"]]), F.array_position(f"all{MARK}", best).cast("int"))
    no_text = ~F.exists(c["text"], lambda x: x != 0)
    chance = F.round(best, 6)
    return out.select(*names, which.alias(f"{prefix}language"), chance.alias(f"{prefix}chance"), ((which != "und") & (chance >= accept) & ~no_text).alias(f"{prefix}accepted"))


def page_languages(pages: DataFrame, model: TrigramModel, html: str = "html", url: str = "url") -> DataFrame:
    """identify() for web pages: visible text, the html element's lang, the address's suffix and language folder, its host and parent domain."""

    @F.arrow_udf("string")
    def visible(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else NO_TEXT.sub(" ", t) for t in texts.to_pylist()], pa.string())

    page, address = F.col(f"`{html}`"), F.lower(F.col(f"`{url}`"))
    host = F.regexp_extract(address, r"^[a-z][a-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)
    folder = F.regexp_extract(address, r"^[a-z][a-z0-9+.-]*://[^/?#]+/([a-z]{2})(?:[/?#]|$)", 1)
    suffix = F.concat(F.substring_index(host, ".", -1), F.lit("/"), folder)
    declared = F.substring_index(F.regexp_extract(page, r"(?i)<html[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3}(?:-[a-z0-9]+)*)", 1), "-", 1)
    return identify(pages, model, visible(page), declared, F.when(host != "", suffix), host, F.substring_index(host, ".", -2))


def spoken(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", doc_id: str = "doc_id", sample_rows: int = 4000, accept: float = 0.5) -> DataFrame:
    """The rows of `docs` whose language is accepted, columns as given: `source` serves as host; `lang` only labels the sample that the model is fitted on."""
    model = fit(docs, text, lang, doc_id, sample_rows)
    found = identify(docs, model, F.col(f"`{text}`"), None, None, F.col(f"`{source}`"), None, accept, prefix=MARK)
    return found.where(F.col(f"{MARK}accepted")).select(*[F.col(f"`{c}`") for c in docs.columns])
