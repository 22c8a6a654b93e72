"""Dashboard panels and the run report execute end to end (sf 0.001)."""

from segkit.plans import segmentation as SG
from segkit.plans.dashboard import Dashboard
from segkit.plans.report import run_report
from segkit.sources.fixtures import buyers_ordered
from tests.conftest import SF_SMALL


def test_segmentation_dashboard_and_report(spark):
    seg = SG.segment(buyers_ordered(spark, SF_SMALL), ks=range(2, 6), n_init_sweep=2, n_init_final=3)
    assert seg.k in range(2, 6) or seg.k == 4
    assert [r[0] for r in seg.k_table] == [2, 3, 4, 5]
    rep = run_report(seg)
    for name, df in rep.items():
        assert df.collect() is not None, name
    assert rep["sizes_kmeans"].count() == seg.k
    assert rep["linkage"].count() >= seg.k - 1
    dash = Dashboard.load(seg.labelled, labels={"HOUSEHOLD": "Home"})
    sel = {"client_type": "All", "country": []}
    panels = {**dash.overview(sel), **dash.investors(sel), **dash.geography(sel),
              **dash.insights(["HOUSEHOLD", "MACHINERY", "NOPE"], sel)}
    for name, df in panels.items():
        df.collect()
    cards = {r["cohort_label"]: r["n"] for r in panels["cards"].collect()}
    assert cards["NOPE"] == 0
    total = dash.table.count()
    assert dash.share({"cluster_name": ["Segment 0"]}).first()["total"] == total
    dash.release()
