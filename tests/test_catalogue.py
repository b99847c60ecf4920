import pytest

from roadlens.plans import catalogue
from tests.conftest import same_rows


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_its_sql(name, spark, sf, duck):
    same_rows(catalogue.QUERIES[name](spark, sf), duck.sql(catalogue.ORACLES[name]))


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_query_without_sql_runs(name, spark, sf):
    assert catalogue.QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    rows = {r["severity"]: r["n"] for r in entry.entry(spark).collect()}
    assert set(rows) <= {"minor", "moderate", "severe"} and sum(rows.values()) > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_near_copies_are_removed_with_exact_ones(spark, sf):
    gone = {name: sum(r["removed"] for r in catalogue.QUERIES[name](spark, sf).collect()) for name in ("dedupe_removals", "dedupe_removals_combined")}
    ranked = {r["path"]: r for r in catalogue.QUERIES["dedupe_keepers_combined"](spark, sf).collect()}
    pairs = catalogue.QUERIES["near_duplicate_pairs"](spark, sf).collect()
    path = {r["doc_id"]: r["path"] for r in catalogue.fx.hashed_files(spark, sf).collect()}
    assert pairs and all(ranked[path[p["id_a"]]]["cluster"] == ranked[path[p["id_b"]]]["cluster"] for p in pairs)
    assert gone["dedupe_removals_combined"] > gone["dedupe_removals"]


def test_every_image_is_in_the_histogram(spark, sf):
    counted = sum(r["n"] for r in catalogue.QUERIES["resolution_histogram_all"](spark, sf).collect())
    assert counted == catalogue.fx.images(spark, sf).count() > 300


@pytest.mark.parametrize(("missing", "absent"), [("roadlens.llm", True), ("roadlens.llm.queries", True), ("roadlens.llm.sql", False), ("numpy", False)])
def test_only_the_subpackage_itself_may_be_absent(missing, absent, monkeypatch):
    import __spark_entry__ as entry

    def gone(name):
        raise ModuleNotFoundError(missing, name=missing)

    monkeypatch.setattr(entry.importlib, "import_module", gone)
    if absent:
        assert entry._optional("roadlens.llm.queries") is None
    else:
        with pytest.raises(ModuleNotFoundError):
            entry._optional("roadlens.llm.queries")
