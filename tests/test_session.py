"""Settings that the queries bring to sessions made elsewhere."""

from __future__ import annotations

from types import SimpleNamespace

from sparktrips import session
from sparktrips.sources import tables


def fake(java_options="", **conf):
    """A session of these settings."""
    runtime = SimpleNamespace(get=lambda k, d=None: conf.get(k, d), set=conf.__setitem__)
    submitted = {"spark.executor.extraJavaOptions": java_options} if java_options else {}
    return SimpleNamespace(conf=runtime, sparkContext=SimpleNamespace(getConf=lambda: submitted), read=SimpleNamespace(parquet=lambda path: path)), conf


def test_stages_too_long_for_hotspot_run_by_operator():
    name, _, ours = session.HUGE_METHODS
    plain, conf = fake()
    assert tables.read_table(plain, "d", "t") == "d/t.parquet" and conf == {name: ours}
    own, conf = fake(**{name: "20000"})
    session.small_methods(own)
    assert conf == {name: "20000"}
    flagged, conf = fake(session.DEFAULT_CONF["spark.executor.extraJavaOptions"])
    session.small_methods(flagged)
    assert conf == {}
