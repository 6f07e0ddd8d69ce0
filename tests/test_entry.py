"""Driver contract: entry(), queries() and oracle_sql()."""

import duckdb

from conftest import SF001

import __spark_entry__ as E

TRAINED = {"train_score_rf", "train_score_dt", "train_score_adaboost", "model_metrics", "kmeans_segments",
           "elbow", "elbow_raw", "silhouette", "cluster_indices", "feature_importance", "tune_tree", "score_batch"}


def _dealt(name):
    """Queries that the llm subpackage adds; tests/llm covers them."""
    return name == "pipeline" or name.startswith("op") and name[2:].split("_")[0].isdigit()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"ref_date", "user_id", "state", "cluster"} <= set(df.columns)


def test_oracle_keys_are_queries():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 60
    # only model fits / k-means labels are rows-only
    own = {q for q in qs if not _dealt(q)}
    assert own - set(sql) == TRAINED


def test_every_query_resolves(spark):
    for name, fn in E.queries().items():
        if name in TRAINED or _dealt(name):
            continue
        cols = fn(spark, SF001).columns
        assert cols and len(cols) == len(set(cols)), name


def test_oracle_sql_parses_and_matches_columns(spark):
    con = duckdb.connect()
    for t in ["customer", "part", "orders", "lineitem", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    qs = E.queries()
    for name in ["dau", "mau_rolling_28", "segmentation_backfill_daily", "fs_transactional_main",
                 "fs_education", "fs_life_cycle", "abt"]:
        res = con.execute(E.oracle_sql()[name])
        ocols = [d[0] for d in res.description]
        assert sorted(ocols) == sorted(qs[name](spark, SF001).columns), name


def test_building_a_query_runs_no_job(spark, monkeypatch):
    """Nothing is computed before the first action, but for queries that
    stage a table (the ABT's, a day's states, the rounds of exact quantiles)
    or fit a model. Tables are opened with a known
    schema here, as looking into a file's footer is a job too."""
    import inspect
    from loyalspark.sources import fixtures as fx
    schemas = {}

    def known(spark, sf_dir, name):
        path = f"{sf_dir}/{name}.parquet"
        if path not in schemas:
            schemas[path] = spark.read.parquet(path).schema
        return spark.read.schema(schemas[path]).parquet(path)

    for t in ("events", "orders", "lineitem", "part", "customer"):
        known(spark, SF001, t)
    monkeypatch.setattr(fx, "table", known)
    tracker = spark.sparkContext.statusTracker()
    for name, fn in E.queries().items():
        if name in TRAINED or _dealt(name):
            continue
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        source = inspect.getsource(inspect.getclosurevars(fn).nonlocals["fn"])
        if any(x in source for x in ("staged_abt", "abt_frame_keyed", "_scored_fixed", "lc_states", "describe_by(")):
            continue
        fn(spark, SF001)
        assert not tracker.getJobIdsForGroup(f"build-{name}"), name
    spark.sparkContext.setJobGroup("", "")
