"""What the similarity join and its components leave to the driver: few scans a round, and no broadcast once it is read."""

from pathlib import Path

from psmlake.llm import components, jaccard_join


def test_a_round_of_components_reads_its_table_four_times_at_most(spark, monkeypatch):
    plans, write = [], components.written

    def seen(df, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, *args)

    monkeypatch.setattr(components, "written", seen)
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 102)], "a long, b long")
    got = {r.node: r.component for r in components.components(edges).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 103), 100)}
    assert len(plans) > 2 and max(p.count("FileScan") for p in plans) <= 4


def test_tables_of_n_grams_are_given_up_when_the_join_ends(spark, monkeypatch):
    made, send = [], spark.sparkContext.broadcast
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda x: made.append(send(x)) or made[-1])
    words = [f"w{i}" for i in range(60)]
    rows = [(0, " ".join(words)), (1, " ".join([*words, "more"])), (2, " ".join(words[::-1])), (3, " ".join([*words, "more", "again"]))]
    found = jaccard_join.similarity_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    paths = [b._path for b in made]
    assert len(paths) == 2 and not any(Path(p).exists() for p in paths)
    assert {r.doc_id: r.component_id for r in found.collect()} == {0: 0, 1: 0, 2: 2, 3: 0}
