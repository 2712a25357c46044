"""Rollups, coverage, digestion, chromatogram merging, databases, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from psmlake.operators import annotate, coverage, digest, qc, rollup, sequences, sic_merge
from psmlake.queries.adapters import ANNOTATED_SQL, PSM_SQL, annotated, psm, rounded, table


def _rollup(method: str, mode: str = "all_matches", alpha: float | None = None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = annotate.uniqueness(annotated(spark, sf_dir))
        values, _ = rollup.protein_rollup(rows, method, mode, outlier_alpha=alpha)
        return rounded(values, "value", digits=4)

    return run


def rollup_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = annotated(spark, sf_dir).withColumn("Unique", F.col("PeptideFlanked") == "P3")
    _, facts = rollup.protein_rollup(rows)
    return facts.withColumns({"has_unique": F.col("has_unique").cast("int"), "has_shared": F.col("has_shared").cast("int")})


def requires_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = annotated(spark, sf_dir).withColumn("Unique", (F.col("PeptideFlanked") == "P3") & (F.col("sample") == "1997") & (F.col("intensity") > 40000))
    values, _ = rollup.protein_rollup(rows, "sum", "requires_unique")
    return rounded(values, "value", digits=2)


def _letters(text: Column | str) -> Column:
    return F.upper(F.regexp_replace(text, "[^A-Za-z]", ""))


def _documents_as_proteins(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("source").alias("sample"), F.col("doc_id").cast("string").alias("Protein"), _letters("text").alias("Sequence"), *more)


def coverage_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as proteins: four fixed pieces as peptides, found at every place."""
    docs = _documents_as_proteins(spark, sf_dir)
    cores = F.array(F.lit("THE"), F.lit("TION"), F.lit("ANTH"), F.lit("THETHE"))
    rows = docs.select("Protein", "sample", F.explode(cores).alias("c")).select("Protein", "sample", F.concat(F.lit("-."), F.col("c"), F.lit(".-")).alias("PeptideFlanked"), F.lit(1.0).alias("intensity"))
    return rounded(coverage.coverage(rows, docs, min_num_pep=1), "coverage")


def _own_words(df: DataFrame, *names: str) -> DataFrame:
    """(names, c): each text's different words, letters only; no exchange is needed, as a text is one row."""
    letters = F.upper(F.regexp_replace("text", r"[^A-Za-z\x20\x09-\x0D]+", ""))
    return df.select(*names, F.explode(F.array_distinct(F.split(letters, r"[\x20\x09-\x0D]+"))).alias("c")).where("c <> ''")


def coverage_of_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as proteins: the words of benchmark items as peptides, found at every place in the documents that have them among their words."""
    docs = _documents_as_proteins(spark, sf_dir, "text")
    known = _own_words(table(spark, sf_dir, "benchmark")).distinct()
    rows = _own_words(docs, "Protein", "sample").join(known, "c", "left_semi")
    rows = rows.select("Protein", "sample", F.concat(F.lit("-."), F.col("c"), F.lit(".-")).alias("PeptideFlanked"), F.lit(1.0).alias("intensity"))
    return rounded(coverage.coverage(rows, docs, min_num_pep=1), "coverage")


def coverage_by_database(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two databases with the same ids: letters of conversations' turns, and the same backwards; even and odd turns are the samples, each with a database of its own.

    A conversation's words are its peptides, preceded by the letter before them where they have one.
    """
    rows = table(spark, sf_dir, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("Protein"), F.when(F.col("turn") % 2 == 0, " Run_0.fasta").otherwise("run_1_rescored").alias("sample"), "text")
    letters = rows.select("Protein", _letters("text").alias("Sequence"))
    proteins = letters.withColumn("database", F.lit("forward")).unionByName(letters.select("Protein", F.reverse("Sequence").alias("Sequence"), F.lit("backward").alias("database")))
    databases = spark.createDataFrame([("run_0", "forward"), ("RUN_1", "backward")], "sample string, database string")
    words = _own_words(rows, "Protein", "sample").where(F.length("c") > 1)
    # the first letter as the flank of the rest
    found = words.select("Protein", "sample", F.concat(F.substring("c", 1, 1), F.lit("."), F.substring("c", 2, 1_000_000), F.lit(".-")).alias("PeptideFlanked"), F.lit(1.0).alias("intensity"))
    return rounded(coverage.coverage(found, proteins, min_num_pep=2, databases=databases), "coverage")


def digest_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Letters of all documents as proteins; each piece ends after K or R without P behind, or at the end; whole pieces, semi-specific runs of three at most, all substrings."""
    docs = table(spark, sf_dir, "documents").select(F.upper(F.regexp_replace("text", "[^A-Za-z]+", "")).alias("Sequence"))
    kinds = {"full": digest.candidates(F.col("Sequence"), 6, 40, 0), "semi": digest.candidates(F.col("Sequence"), 6, 40, 2, 1), "any": digest.candidates(F.col("Sequence"), 6, 40, enzyme=0)}
    sums = docs.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(kind) for kind, c in kinds.items()])  # one scan for all
    return sums.select(F.inline(F.array(*[F.struct(F.col(kind).alias("n_peptides"), F.lit(kind).alias("kind")) for kind in kinds])))


def merge_sics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First hits from orders, scan statistics from customers, chromatograms from parts; each sample has its own scans."""
    hits = table(spark, sf_dir, "orders").select(F.year("o_orderdate").cast("string").alias("sample"), F.col("o_custkey").alias("Scan"), F.col("o_orderkey").alias("key"))
    samples = F.explode(F.array(*[F.lit(str(y)) for y in range(1990, 2011)])).alias("sample")
    scans = table(spark, sf_dir, "customer").where("c_custkey % 11 > 0").select(samples, F.col("c_custkey").alias("ScanNumber"), (F.col("c_acctbal") / 100).alias("ScanTime"), F.col("c_mktsegment").alias("ScanType"), F.col("c_acctbal").alias("TotalIonIntensity"), F.lit(1.0).alias("BasePeakIntensity"), F.lit(2.0).alias("BasePeakMZ"))
    sics = table(spark, sf_dir, "part").select(
        samples, F.col("p_partkey").alias("FragScanNumber"), (F.col("p_partkey") + 1).alias("OptimalPeakApexScanNumber"), F.col("p_retailprice").alias("PeakMaxIntensity"), F.lit(1.0).alias("PeakSignalToNoiseRatio"), F.lit(1.0).alias("FWHMInScans"), F.col("p_size").cast("double").alias("PeakArea"),
        F.col("p_retailprice").alias("ParentIonIntensity"), F.lit(3.0).alias("MZ"), F.lit(1.0).alias("StatMomentsArea"), (F.col("p_partkey") - 1).alias("PeakScanStart"), (F.col("p_partkey") + 2).alias("PeakScanEnd"),
    )
    out = sic_merge.merge_sics(hits, scans, sics)
    return rounded(out.select("sample", "Scan", "key", "ElutionTime", "ScanType", "OptimalScanNumber", "ParentIonIntensity", "PeakWidthMinutes"), "ElutionTime", "ParentIonIntensity").withColumn("PeakWidthMinutes", F.round("PeakWidthMinutes", 4))


def database_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ord"), F.col("source").alias("Protein"), F.col("text").alias("Sequence"))
    return sequences.without_redundancy(docs).select("ord", "Protein", F.length("Sequence").alias("n"))


def database_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as records of one id: turns joined in order, the last role kept."""
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("Protein"), F.col("turn").alias("ord"), F.col("text").alias("Sequence"), F.col("role").alias("Description"))
    joined = sequences.joined_by_id(rows).select("Protein", F.length("Sequence").alias("n"), F.md5(F.encode("Sequence", "UTF-8")).alias("digest"))
    return joined.join(sequences.last_by_id(rows), "Protein")


def genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.col("p_name"), F.lit(" OS="), F.col("p_brand"), F.when(F.col("p_size") > 10, F.concat(F.lit(" GN="), F.col("p_type"))).otherwise(""))
    rows = table(spark, sf_dir, "part").select("p_partkey", annotate.function_and_gene(text).alias("x"))
    return rows.select("p_partkey", F.col("x.function").alias("function"), F.col("x.gene").alias("gene"))


def tic(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("sample"), ((F.unix_micros(F.col("ts").cast("timestamp")) % 86400000000) / 6e7).alias("rt"), F.array(F.col("value"), F.col("value") * 2).alias("intensity"))
    return rounded(qc.tic(rows, 600.0), "rt_minutes", "tic", digits=4)


def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(qc.histogram(psm(spark, sf_dir), "score", ("sample", "is_decoy"), 0.0, 51.0, 17), "density", digits=9)


def z_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = qc.z_scores(psm(spark, sf_dir), "score", ("sample",))
    return rounded(rows.groupBy("sample", "is_decoy").agg(F.avg("z").alias("mean"), F.max("z").alias("top")), "mean", "top", digits=4)


def auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(qc.roc_auc(psm(spark, sf_dir), "score", "is_decoy", ("sample",)), "auc", digits=6)


def average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(qc.average_precision(psm(spark, sf_dir), "score", "is_decoy", ("sample",)), "average_precision", digits=6)


def residual_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = psm(spark, sf_dir).select("sample", (F.col("ParentIonIntensity") / 1000).alias("observed"), F.col("score").alias("predicted"))
    return rounded(qc.rt_agreement(rows, "observed", "predicted", ("sample",)), "median_error", "mad", "mae", "normalised_mae", "pearson", digits=3)


def top_proteins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = annotated(spark, sf_dir).groupBy("Protein", "sample").agg(F.max("intensity").alias("coverage"))
    return rounded(qc.top_rows(rows, "coverage", 20), "top", digits=2)


QUERIES = {
    "rollup_sum": _rollup("sum"), "rollup_reference": _rollup("rrollup"), "rollup_reference_grubbs": _rollup("rrollup", alpha=0.05), "rollup_z": _rollup("zrollup"), "rollup_top": _rollup("qrollup"), "rollup_weighted": _rollup("dwrollup"),
    **{f.__name__: f for f in (rollup_facts, requires_unique, coverage_of_documents, coverage_of_benchmark, coverage_by_database, digest_count, merge_sics, database_dedup, database_ids, genes, tic, histogram, z_density, auc, average_precision, residual_stats, top_proteins)},
}

_GRID = "grid AS (SELECT Protein, sample FROM (SELECT DISTINCT Protein FROM ann), (SELECT DISTINCT sample FROM ann))"
_REF = """v AS (SELECT Protein, PeptideFlanked, sample, log2(intensity) AS v FROM ann WHERE intensity > 0),
 refs AS (SELECT Protein, PeptideFlanked AS ref FROM (SELECT Protein, PeptideFlanked, count(*) AS n, median(v) AS m FROM v GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY Protein ORDER BY n DESC, m DESC, PeptideFlanked) = 1),
 m AS (SELECT v.*, ref, max(CASE WHEN v.PeptideFlanked = ref THEN v END) OVER (PARTITION BY v.Protein, sample) AS rv FROM v JOIN refs USING (Protein)),
 f AS (SELECT Protein, PeptideFlanked, median(rv - v) AS f FROM m GROUP BY ALL),
 s AS (SELECT m.Protein, m.PeptideFlanked, sample, CASE WHEN m.PeptideFlanked = ref THEN v ELSE v + f END AS v FROM m JOIN f USING (Protein, PeptideFlanked))"""

SQL = {
    "rollup_sum": f"WITH {ANNOTATED_SQL}, {_GRID}, s AS (SELECT Protein, sample, sum(intensity) AS v FROM ann GROUP BY ALL) SELECT Protein, sample, round(coalesce(v, 0.0), 4) AS value FROM grid LEFT JOIN s USING (Protein, sample)",
    "rollup_reference": f"WITH {ANNOTATED_SQL}, {_GRID}, {_REF}, o AS (SELECT Protein, sample, median(v) AS v FROM s GROUP BY ALL) SELECT Protein, sample, round(pow(2.0, v), 4) AS value FROM grid LEFT JOIN o USING (Protein, sample)",
    "rollup_z": f"""WITH {ANNOTATED_SQL}, {_GRID}, v AS (SELECT Protein, PeptideFlanked, sample, log2(intensity) AS v FROM ann WHERE intensity > 0),
        z AS (SELECT *, (v - avg(v) OVER w) / nullif(stddev_samp(v) OVER w, 0) AS z FROM v WINDOW w AS (PARTITION BY Protein, PeptideFlanked)),
        o AS (SELECT Protein, sample, median(z) AS v FROM z WHERE Protein IN (SELECT Protein FROM ann GROUP BY Protein HAVING count(DISTINCT PeptideFlanked) > 1) GROUP BY ALL)
        SELECT Protein, sample, round(v, 4) AS value FROM grid LEFT JOIN o USING (Protein, sample)""",
    "rollup_top": f"""WITH {ANNOTATED_SQL}, {_GRID}, v AS (SELECT Protein, PeptideFlanked, sample, log2(intensity) AS v FROM ann WHERE intensity > 0),
        m AS (SELECT Protein, PeptideFlanked, avg(v) AS m FROM v GROUP BY ALL), b AS (SELECT Protein, quantile_cont(m, 1.0 - 1.0 / 3.0) AS b FROM m GROUP BY ALL),
        o AS (SELECT Protein, sample, avg(v) AS v FROM v JOIN m USING (Protein, PeptideFlanked) JOIN b USING (Protein) WHERE m >= b GROUP BY ALL) SELECT Protein, sample, round(pow(2.0, v), 4) AS value FROM grid LEFT JOIN o USING (Protein, sample)""",
    "rollup_weighted": f"""WITH {ANNOTATED_SQL}, {_GRID}, w AS (SELECT PeptideFlanked, 1.0 / count(DISTINCT Protein) AS w FROM ann GROUP BY ALL), p AS (SELECT DISTINCT Protein, PeptideFlanked FROM ann),
        n AS (SELECT Protein, PeptideFlanked, w / sum(w) OVER (PARTITION BY Protein) AS w FROM p JOIN w USING (PeptideFlanked)), o AS (SELECT Protein, sample, sum(intensity * w) AS v FROM ann JOIN n USING (Protein, PeptideFlanked) GROUP BY ALL)
        SELECT Protein, sample, round(coalesce(v, 0.0), 4) AS value FROM grid LEFT JOIN o USING (Protein, sample)""",
    "rollup_facts": f"""WITH {ANNOTATED_SQL} SELECT Protein, count(DISTINCT PeptideFlanked) AS peptide_number, CAST(bool_or(PeptideFlanked = 'P3') AS INT) AS has_unique, CAST(bool_or(PeptideFlanked <> 'P3') AS INT) AS has_shared,
        array_to_string(list_sort(list(DISTINCT Peptide)), ';') AS peptides, array_to_string(list_sort(list(DISTINCT PeptideFlanked)), ';') AS flanked_peptides FROM ann GROUP BY Protein""",
    "requires_unique": f"""WITH {ANNOTATED_SQL}, k AS (SELECT * FROM ann WHERE Protein IN (SELECT Protein FROM ann WHERE PeptideFlanked = 'P3' AND sample = '1997' AND intensity > 40000)),
        g AS (SELECT Protein, sample FROM (SELECT DISTINCT Protein FROM k), (SELECT DISTINCT sample FROM k)), s AS (SELECT Protein, sample, sum(intensity) AS v FROM k GROUP BY ALL)
        SELECT Protein, sample, round(coalesce(v, 0.0), 2) AS value FROM g LEFT JOIN s USING (Protein, sample)""",
    "coverage_of_documents": """WITH d AS (SELECT CAST(doc_id AS VARCHAR) AS Protein, source AS sample, upper(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS s FROM documents),
        pep AS (SELECT unnest(['THE', 'TION', 'ANTH', 'THETHE']) AS c),
        hits AS (SELECT Protein, sample, c, s, unnest([i for i in generate_series(1, length(s) - length(c) + 1) if substr(s, i, length(c)) = c]) AS i FROM d, pep WHERE contains(s, c)),
        cells AS (SELECT DISTINCT Protein, sample, unnest(generate_series(i, i + length(c) - 1)) AS p FROM hits),
        n AS (SELECT Protein, sample, count(*) AS n FROM cells GROUP BY ALL)
        SELECT d.Protein, d.sample, 4 AS num_pep, round(100.0 * coalesce(n, 0) / length(s), 6) AS coverage FROM d LEFT JOIN n USING (Protein, sample) WHERE length(s) > 0""",
    "coverage_of_benchmark": """WITH d AS (SELECT CAST(doc_id AS VARCHAR) AS Protein, source AS sample, text, upper(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS s FROM documents),
        b AS (SELECT DISTINCT upper(regexp_replace(w, '[^A-Za-z]', '', 'g')) AS c FROM (SELECT unnest(string_split_regex(text, '[\\x20\\x09-\\x0D]+')) AS w FROM benchmark)),
        w AS (SELECT DISTINCT Protein, upper(regexp_replace(w, '[^A-Za-z]', '', 'g')) AS c FROM (SELECT Protein, unnest(string_split_regex(text, '[\\x20\\x09-\\x0D]+')) AS w FROM d)),
        pep AS (SELECT Protein, c FROM w JOIN b USING (c) WHERE c <> ''), m AS (SELECT Protein, count(*) AS num_pep FROM pep GROUP BY Protein), l AS (SELECT DISTINCT length(c) AS n FROM pep),
        places AS (SELECT Protein, n, s, unnest(generate_series(1, length(s) - n + 1)) AS i FROM d, l WHERE length(s) >= n),
        hits AS (SELECT Protein, i, n FROM (SELECT Protein, i, n, substr(s, i, n) AS c FROM places) JOIN pep USING (Protein, c)),
        cells AS (SELECT DISTINCT Protein, unnest(generate_series(i, i + n - 1)) AS p FROM hits), k AS (SELECT Protein, count(*) AS k FROM cells GROUP BY Protein)
        SELECT Protein, sample, num_pep, round(100.0 * k / length(s), 6) AS coverage FROM d JOIN m USING (Protein) JOIN k USING (Protein)""",
    "coverage_by_database": """WITH d AS (SELECT conv_id || '-' || turn AS Protein, CASE WHEN turn % 2 = 0 THEN ' Run_0.fasta' ELSE 'run_1_rescored' END AS sample, text, turn,
            upper(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS f FROM conversations),
        e AS (SELECT Protein, sample, text, CASE WHEN turn % 2 = 0 THEN f ELSE reverse(f) END AS s FROM d),
        w AS (SELECT DISTINCT Protein, sample, s, upper(regexp_replace(w, '[^A-Za-z]', '', 'g')) AS c FROM (SELECT Protein, sample, s, unnest(string_split_regex(text, '[\\x20\\x09-\\x0D]+')) AS w FROM e)),
        pep AS (SELECT * FROM w WHERE length(c) > 1), m AS (SELECT Protein, sample, s, count(*) AS num_pep FROM pep WHERE s <> '' GROUP BY ALL),
        hits AS (SELECT Protein, c, unnest([i for i in generate_series(1, length(s) - length(c) + 1) if substr(s, i, length(c)) = c]) AS i FROM pep WHERE contains(s, c)),
        cells AS (SELECT DISTINCT Protein, unnest(generate_series(i + 1, i + length(c) - 1)) AS p FROM hits), k AS (SELECT Protein, count(*) AS k FROM cells GROUP BY Protein)
        SELECT Protein, sample, num_pep, round(100.0 * coalesce(k, 0) / length(s), 6) AS coverage FROM m LEFT JOIN k USING (Protein) WHERE num_pep >= 2""",
    "digest_count": """WITH d AS (SELECT doc_id, upper(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS s FROM documents),
        f AS (SELECT doc_id, list_filter(string_split(regexp_replace(regexp_replace(s, '([KR])', '\\1|', 'g'), '\\|P', 'P', 'g'), '|'), lambda p: p <> '') AS f FROM d),
        l AS (SELECT doc_id, unnest(list_transform(f, lambda p: length(p))) AS a, unnest(range(len(f))) AS i FROM f),
        w AS (SELECT a, a + lead(a) OVER (PARTITION BY doc_id ORDER BY i) AS b, a + lead(a) OVER (PARTITION BY doc_id ORDER BY i) + lead(a, 2) OVER (PARTITION BY doc_id ORDER BY i) AS c FROM l)
        SELECT count(*) AS n_peptides, 'full' AS kind FROM l WHERE a BETWEEN 6 AND 40
        UNION ALL SELECT CAST(sum(greatest(0, least(40, n) - 5)) AS BIGINT), 'semi' FROM (SELECT unnest([a, b, c]) AS n FROM w) WHERE n IS NOT NULL
        UNION ALL SELECT CAST(sum(greatest(0, length(s) - n + 1)) AS BIGINT), 'any' FROM d, range(6, 41) r(n)""",
    "merge_sics": """WITH h AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS sample, o_custkey AS Scan, o_orderkey AS key FROM orders), c AS (SELECT c_custkey, c_acctbal / 100 AS t, c_mktsegment FROM customer WHERE c_custkey % 11 > 0)
        SELECT sample, Scan, key, round(a.t, 6) AS ElutionTime, a.c_mktsegment AS ScanType, p_partkey + 1 AS OptimalScanNumber, round(p_retailprice, 6) AS ParentIonIntensity, round(coalesce(e.t - s.t, 0.0), 4) AS PeakWidthMinutes
        FROM h LEFT JOIN c a ON a.c_custkey = Scan LEFT JOIN part ON p_partkey = Scan LEFT JOIN c s ON s.c_custkey = p_partkey - 1 LEFT JOIN c e ON e.c_custkey = p_partkey + 2""",
    "database_dedup": "SELECT doc_id AS ord, source AS Protein, length(text) AS n FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1",
    "database_ids": "SELECT CAST(conv_id AS VARCHAR) AS Protein, length(string_agg(text, '' ORDER BY turn, text)) AS n, md5(string_agg(text, '' ORDER BY turn, text)) AS digest, arg_max(role, turn) AS Description FROM conversations GROUP BY conv_id",
    "genes": "SELECT p_partkey, trim(p_name) AS function, CASE WHEN p_size > 10 THEN regexp_extract(p_type, '^[^\\s;|]+') ELSE 'Unknown' END AS gene FROM part",
    "tic": """WITH e AS (SELECT event_type AS sample, (epoch_us(ts) % 86400000000) / 6e7 AS rt, value * 3 AS v FROM events), s AS (SELECT sample, rt - min(rt) OVER (PARTITION BY sample) AS r, v FROM e)
        SELECT sample, round(r, 4) AS rt_minutes, round(v, 4) AS tic FROM s WHERE r < 600""",
    "histogram": f"""WITH {PSM_SQL}, b AS (SELECT sample, is_decoy, least(16, CAST(floor(score / 3.0) AS INT)) AS bin, count(*) AS n FROM psm WHERE score BETWEEN 0 AND 51 GROUP BY ALL)
        SELECT sample, is_decoy, bin, n, round(n / (sum(n) OVER (PARTITION BY sample, is_decoy) * 3.0), 9) AS density FROM b""",
    "z_density": f"""WITH {PSM_SQL}, z AS (SELECT sample, is_decoy, (score - avg(score) OVER w) / nullif(stddev_pop(score) OVER w, 0) AS z FROM psm WINDOW w AS (PARTITION BY sample)) SELECT sample, is_decoy, round(avg(z), 4) AS mean, round(max(z), 4) AS top FROM z GROUP BY ALL""",
    "auc": f"""WITH {PSM_SQL}, r AS (SELECT sample, is_decoy, rank() OVER (PARTITION BY sample ORDER BY score) + (count(*) OVER (PARTITION BY sample, score) - 1) / 2.0 AS r FROM psm)
        SELECT sample, round((sum(r) FILTER (is_decoy = 0) - count(*) FILTER (is_decoy = 0) * (count(*) FILTER (is_decoy = 0) + 1) / 2.0) / (CAST(count(*) FILTER (is_decoy = 0) AS DOUBLE) * count(*) FILTER (is_decoy = 1)), 6) AS auc FROM r GROUP BY sample""",
    "average_precision": f"""WITH {PSM_SQL}, s AS (SELECT sample, score, sum(1 - is_decoy) AS t, count(*) AS n FROM psm GROUP BY ALL), c AS (SELECT sample, score, t, sum(t) OVER w AS ct, sum(n) OVER w AS cn, sum(t) OVER (PARTITION BY sample) AS total FROM s WINDOW w AS (PARTITION BY sample ORDER BY score DESC))
        SELECT sample, round(sum(t / total * ct / cn), 6) AS average_precision FROM c GROUP BY sample""",
    "residual_stats": f"""WITH {PSM_SQL}, r AS (SELECT sample, ParentIonIntensity / 1000 AS o, score AS p FROM psm), m AS (SELECT sample, median(o - p) AS med FROM r GROUP BY ALL)
        SELECT sample, round(any_value(med), 3) AS median_error, round(median(abs(o - p - med)), 3) AS mad, round(avg(abs(o - p)), 3) AS mae, round(avg(abs(o - p)) / nullif(max(o) - min(o), 0), 3) AS normalised_mae, round(corr(o, p), 3) AS pearson, count(*) AS n FROM r JOIN m USING (sample) GROUP BY sample""",
    "top_proteins": f"WITH {ANNOTATED_SQL} SELECT Protein, round(max(intensity), 2) AS top FROM ann GROUP BY Protein ORDER BY max(intensity) DESC, Protein LIMIT 20",
}
