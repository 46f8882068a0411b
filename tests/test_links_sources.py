"""Linked records, the four sources of the release table."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortloom.functions import dims
from cohortloom.operators import links, workflow
from cohortloom.sources import fixtures as FX

SF = "/root/testdata/sf0.001"
POOL = "id string, depends_on string, product string, release_version string, status string"


def ends(spark, rows):
    df = spark.createDataFrame(rows, "id string, depends_on string")
    return {r["id"]: (r["root"], r["depth"], r["in_cycle"]) for r in links.link_ends(df).collect()}


def walked(rows):
    link = {}
    for i, d in rows:
        if i is not None:
            link[i] = min([x for x in (link.get(i), d) if x is not None], default=None)
    out = {}
    for i in link:
        path, at = [i], link[i]
        while at is not None and at in link and at not in path:
            path.append(at)
            at = link[at]
        if at is not None and at in link:
            cycle = path[path.index(at):]
            out[i] = (min(cycle), None, i in cycle)
        else:
            out[i] = (path[-1], len(path) - 1, False)
    return out


def test_chain_cycle_and_missing_parent(spark):
    rows = [("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("e", "f"), ("f", None),      # five links
            ("x", "y"), ("y", "z"), ("z", "x"), ("t", "u"), ("u", "y"),                    # a cycle and what runs into it
            ("s", "s"), ("m", "nowhere"), ("only", None), (None, "a"), ("a", "b")]
    got = ends(spark, rows)
    assert got["a"] == ("f", 5, False) and got["x"] == ("x", None, True) and got["t"] == ("x", None, False)
    assert got["m"] == ("m", 0, False) and got["s"] == ("s", None, True)
    assert got == walked(rows)
    assert ends(spark, []) == {}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 14), st.one_of(st.none(), st.integers(0, 14))), max_size=20))
def test_link_ends_equal_walks(spark, pairs):
    rows = [(str(a), None if b is None else str(b)) for a, b in pairs]
    assert ends(spark, rows) == walked(rows)


def test_long_chain_takes_few_rounds(spark, monkeypatch):
    calls = []
    keep = links.materialize
    monkeypatch.setattr(links, "materialize", lambda df, name: calls.append(name) or keep(df, name))
    n = 300
    got = ends(spark, [(f"{i:04d}", f"{i + 1:04d}") for i in range(n)] + [(f"{n:04d}", None)])
    assert got["0000"] == (f"{n:04d}", n, False) and len(calls) <= 12


def test_ship_groups(spark):
    app, web = dims.APP_PRODUCT, "官网"
    done = dims.POOL_DONE_STATUS
    rows = [("a", "b", app, "V1.3.0", done), ("b", "c", web, None, done), ("c", None, app, "1.3.0", None),
            ("p", "q", app, "1.2.0", done), ("q", None, app, "1.3.0", done), ("alone", None, app, "1.0.0", done)]
    got = {r["root"]: r for r in links.ship_groups(spark.createDataFrame(rows, POOL)).collect()}
    assert set(got) == {"c", "q"}
    assert (got["c"]["records"], got["c"]["done"], got["c"]["longest_chain"], got["c"]["one_app_version"]) == (3, 2, 2, True)
    assert not got["q"]["one_app_version"] and not got["q"]["has_cycle"]


def test_sources_have_shapes_of_their_own(spark):
    sources = FX.other_sources(spark, SF)
    assert len({tuple(rows.columns) for rows, _ in sources.values()}) == 3
    out = workflow.release_union(sources)
    assert out.schema.names == workflow.schemas.RELEASE.names and [f.dataType for f in out.schema] == [f.dataType for f in workflow.schemas.RELEASE]
    assert out.count() == spark.read.parquet(f"{SF}/supplier.parquet").count()


@pytest.mark.parametrize("change, said", [
    ({"priority": 1}, "priority is int"), ({"owner": "nobody"}, "no column nobody"), ({"colour": "what"}, "no field colour"),
    ({"type": "what"}, "source's type"), ({"name": None}, "no mapping for name")])
def test_mapping_is_checked_before_any_row(spark, change, said):
    rows = spark.createDataFrame([("1", "n", "s")], "no string, what string, state string")
    mapping = {"id": "no", "name": "what", "status": "state", **change}
    mapping = {k: F.lit(v) if v == 1 else v for k, v in mapping.items() if v is not None}
    with pytest.raises(ValueError, match=said):
        workflow.release_source(rows, dims.RELEASE_TYPES[1], mapping)
    with pytest.raises(ValueError, match="no type"):
        workflow.release_source(rows, "other", {"id": "no", "name": "what", "status": "state"})
