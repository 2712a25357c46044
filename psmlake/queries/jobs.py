"""The jobs as queries: each runs twice into one new folder, and what then stands there is the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobs import common, sample_report, sequence_index
from psmlake.queries.adapters import rounded


def job1_sample_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as matches; the second run replaces every sample by itself."""
    out = common.new_folder(spark, "sample-report")
    settings = common.config(sample_report.CONFIG, sample_report.DEFAULTS)
    for _ in range(2):
        found = sample_report.run(spark, f"{sf_dir}/lineitem.parquet", out, settings)
    return rounded(found, "q", "pep_q", digits=9)


def job2_sequence_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Letters of all documents as sequences; the second run finds nothing new."""
    out = common.new_folder(spark, "sequence-index")
    settings = common.config(sequence_index.CONFIG, sequence_index.DEFAULTS)
    for _ in range(2):
        found = sequence_index.run(spark, f"{sf_dir}/documents.parquet", f"{out}/index", f"{out}/checkpoint", settings)
    return found


QUERIES = {f.__name__: f for f in (job1_sample_report, job2_sequence_index)}

_TIE = "Scan, Charge, Peptide, Protein, score, tax"


def _q(rows: str, to: str) -> str:
    """q-values of `rows` as the table `to`, column `to`."""
    return f"""{to}_n AS (SELECT *, sum(is_decoy) OVER w AS d, sum(1 - is_decoy) OVER w AS t FROM {rows} WINDOW w AS (PARTITION BY sample ORDER BY score DESC, {_TIE} ROWS UNBOUNDED PRECEDING)),
        {to}_r AS (SELECT *, CASE WHEN t = 0 THEN 1.0 ELSE least(1.0, d / t) END AS r FROM {to}_n),
        {to} AS (SELECT * EXCLUDE (d, t, r), min(r) OVER (PARTITION BY sample ORDER BY score DESC, {_TIE} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS {to} FROM {to}_r)"""


SQL = {
    "job1_sample_report": f"""WITH psm AS (
            SELECT CAST(year(l_shipdate) AS VARCHAR) AS sample, l_orderkey AS Scan, l_linenumber AS Charge, CAST(l_partkey AS VARCHAR) AS Peptide, CAST(l_suppkey AS VARCHAR) AS Protein,
                l_quantity AS score, l_extendedprice AS intensity, l_tax AS tax, CASE WHEN l_returnflag = 'R' AND l_quantity < 30 THEN 1 ELSE 0 END AS is_decoy FROM lineitem
        ), scans AS (SELECT * FROM psm QUALIFY row_number() OVER (PARTITION BY sample, Scan ORDER BY intensity DESC, Charge, Peptide, Protein, score, tax) = 1),
        {_q("scans", "q")}, tops AS (SELECT * EXCLUDE (q) FROM q QUALIFY row_number() OVER (PARTITION BY sample, Peptide ORDER BY score DESC, {_TIE}) = 1),
        {_q("tops", "pep_q")}, found AS (
            SELECT q.sample, q.Peptide, q.Protein, count(*) AS n_psms, max(q.score) AS score, min(q) AS q, min(pep_q) AS pep_q, max(q.intensity) AS intensity
            FROM q JOIN pep_q USING (sample, Peptide) WHERE q.is_decoy = 0 AND q <= 0.05 AND pep_q <= 0.1 GROUP BY ALL
        )
        SELECT sample, Peptide, Protein, count(*) OVER (PARTITION BY sample, Peptide) = 1 AS "unique", n_psms, score, round(q, 9) AS q, round(pep_q, 9) AS pep_q, intensity FROM found""",
    # pieces by number; a run of two is a piece and the next one
    "job2_sequence_index": r"""WITH s AS (SELECT DISTINCT upper(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS s FROM documents),
        f AS (SELECT s, list_filter(string_split(regexp_replace(regexp_replace(s, '([KR])', '\1|', 'g'), '\|P', 'P', 'g'), '|'), lambda p: p <> '') AS f FROM s WHERE s <> ''),
        p AS (SELECT s, unnest(f || list_transform(range(1, len(f)), lambda i: f[i] || f[i + 1])) AS peptide FROM f),
        own AS (SELECT s, peptide, count(*) AS n FROM p WHERE length(peptide) BETWEEN 6 AND 40 GROUP BY ALL)
        SELECT peptide, length(peptide)::INT AS length, count(*) AS n_sequences, sum(n)::BIGINT AS n_places, count(*) = 1 AS "unique" FROM own GROUP BY peptide""",
}
