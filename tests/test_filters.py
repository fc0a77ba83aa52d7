from pyspark.sql import functions as F

from kiln.config import FilterConfig
from kiln.operators import reports
from kiln.operators.filters import quality_metrics
from kiln.plans.tables import metrics

from conftest import SF001


def test_counts_sf0001(spark):
    m = metrics(spark, SF001)
    s = reports.filter_stats(m).first()
    assert (s.seen, s.kept, s.dropped) == (200, 172, 28)
    reasons = {r.reason: r.documents for r in reports.drop_reasons(m).collect()}
    assert reasons == {"too_short": 10, "high_symbol_ratio": 16, "repeated_lines": 4, "token_count": 8}


def test_hand_made_documents(spark):
    rows = [
        (0, ""),
        (1, "word"),
        (2, "x" * 300),
        (3, "ok line\n" * 50),
        (4, ("fine words here " * 30) + "!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!!"),
    ]
    df = spark.createDataFrame(rows, "seq long, text string").withColumn("token_count", F.size(F.split("text", " +")))
    out = {r.seq: r for r in quality_metrics(df, FilterConfig()).collect()}
    # Empty text: every filter but the run filter fails; symbol ratio is 1.0, no lines.
    assert list(out[0].reasons) == ["too_short", "high_symbol_ratio", "repeated_lines", "token_count"]
    assert out[0].symbol_ratio == 1.0 and out[0].repeated_lines == 0.0 and out[0].longest_repeat == 1
    assert out[2].longest_repeat == 300 and "repeated_chars" in out[2].reasons
    assert out[3].repeated_lines == 1.0 and "repeated_lines" in out[3].reasons
    assert "repeated_chars" in out[4].reasons  # several reasons at once, in filter order
    assert list(out[1].reasons)[0] == "too_short"


def test_metric_summary_matches_numpy(spark):
    import numpy as np

    m = metrics(spark, SF001).cache()
    summ = {r.metric: r for r in reports.metric_summary(m).collect()}
    for name in ("char_length", "symbol_ratio", "repeated_lines", "token_count"):
        vals = np.array([r[0] for r in m.select(name).collect()], dtype=float)
        assert abs(summ[name].median - np.median(vals)) < 1e-9
        assert abs(summ[name].p95 - np.percentile(vals, 95)) < 1e-9
        assert abs(summ[name].mean - vals.mean()) < 1e-9
