"""Most frequent values in bounded memory, and the report's single count."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from labelfold.functions.dictionary import make_dictionary
from labelfold.operators import analysis as an
from labelfold.operators import evaluate as ev
from labelfold.operators import frequent as fq
from labelfold.operators.frame import EvalFrame


def brute(values, top):
    counts = Counter(values)
    # ties go to the larger value, null last
    return sorted(counts.items(), key=lambda kv: (kv[1], kv[0] is not None, kv[0] or ""), reverse=True)[:top]


def run(spark, values, top, counters, parts=5):
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(parts)
    found, n, how = fq.top_counts(df, "v", top, counters)
    return [(r.v, r["count"]) for r in found.orderBy(F.desc("count"), F.desc("v")).collect()], n, how


def test_few_values_are_held(spark):
    values = [f"v{i % 9}" for i in range(1000)] + [None] * 40
    got, n, how = run(spark, values, 4, 16)
    assert (got, n, how) == (brute(values, 4), 1040, "held")


def test_nearly_all_differ(spark):
    values = [f"{i:06d}" for i in range(6000)] + ["000007", "000003"]
    got, n, how = run(spark, values, 5, 50)
    assert (got, n, how) == (brute(values, 5), 6002, "counted")


def test_a_third_is_one_value(spark):
    values = [f"{i:06d}" for i in range(6000)] + ["hot"] * 3000
    got, n, how = run(spark, values, 1, 50)
    assert (got, n, how) == ([("hot", 3000)], 9000, "proven")
    got, _, how = run(spark, values, 3, 50)  # behind the hot value nothing stands out
    assert (got, how) == (brute(values, 3), "counted")


@pytest.mark.parametrize("seed", range(2))
def test_skewed_values(spark, seed):
    rng = random.Random(seed)
    values = [str(int(rng.paretovariate(0.7))) for _ in range(5000)] + [None] * rng.choice([0, 900])
    rng.shuffle(values)
    for counters in (8, 64, 1000):
        got, n, _ = run(spark, values, 6, counters, parts=rng.choice([1, 3, 11]))
        assert got == brute(values, 6) and n == len(values)


def test_odd_inputs(spark):
    assert run(spark, [], 3, 8)[:2] == ([], 0)
    assert run(spark, ["a"], 3, 8)[:2] == ([("a", 1)], 1)
    assert run(spark, [None, None], 3, 8)[0] == [(None, 2)]
    with pytest.raises(ValueError):
        run(spark, ["a"], 9, 8)


def wide_frame(spark, rows=3000, k=40):
    """k labels whose vectors nearly all differ, but a third of the rows that have none."""
    bits = [F.expr(f"CAST(id % 3 != 0 AND hash(id, {i}) % 2 = 0 AS INT)") for i in range(k)]
    y = spark.range(rows).select("id", F.array(*bits).alias("y_true"))
    return EvalFrame(y.withColumn("score", F.expr("transform(y_true, x -> CAST(x AS DOUBLE))")).repartition(4), ("id",),
                     make_dictionary([f"c{i}" for i in range(k)]))


def test_label_sets_of_many_labels(spark):
    ef = wide_frame(spark)
    want = an.label_combinations(ef).orderBy("rank").collect()
    assert an.label_combinations(ef, counters=64).orderBy("rank").collect() == want
    assert an.label_combinations(ef, counters=64, truth=True, top=1).first() == want[0]


def test_report_reads_the_frame_three_times(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    ef = wide_frame(spark, 500, 3)
    an.evaluation_report(ef.with_df(ef.df.mapInArrow(counted, ef.df.schema)), str(tmp_path / "r"))
    assert seen.value <= 3 * 500


@pytest.mark.parametrize("op", ["gt", "ge"])
def test_sections_from_the_counts_equal_the_direct_ones(spark, tmp_path, op):
    from labelfold.sources.reports import read_section
    rng = random.Random(5)
    rows = [(i, [rng.randint(0, 1) for _ in range(3)], [rng.choice([0.1, 0.5, 0.9, rng.random(), None, float("nan")]), rng.random(), None])
            for i in range(400)]
    df = spark.createDataFrame(rows, "id long, y_true array<int>, score array<double>").repartition(3)
    ef = EvalFrame(df, ("id",), make_dictionary(["a", "b", "c"]))
    for frame, at in ((ef, "full"), (ef.with_df(ef.df.filter("false")), "empty")):
        path = str(tmp_path / at)
        an.evaluation_report(frame, path, 0.4, op, thresholds=(0.5, 0.1, 0.9))
        direct = {"overall": ev.overall_metrics(frame, 0.4, op), "confusion": ev.confusion(frame, 0.4, op),
                  "per_label": an.per_label_report(frame, 0.4, op),
                  "classification_report": ev.classification_report(frame, 0.4, op),
                  "threshold_sweep": an.threshold_sweep(frame, (0.5, 0.1, 0.9), op),
                  "prediction_distribution": an.prediction_distribution(frame, 0.4, op),
                  "top_label_combinations": an.label_combinations(frame, 0.4, op),
                  "score_histogram": an.score_histogram(frame)}
        for name, want in direct.items():
            got = read_section(spark, path, name, schema=want.schema)

            def rounded(d):
                return sorted((tuple(round(v, 9) if isinstance(v, float) else str(v) for v in r) for r in d.select(*want.columns).collect()), key=repr)
            assert rounded(got) == rounded(want), (at, name)
