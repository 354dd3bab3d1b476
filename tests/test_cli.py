"""spark-submit entry point over an exported Parquet source."""

from utxolake import catalog_queries as cq
from utxolake import cli
from utxolake.sources.loader import SOURCE_RELATIONS, MaterializedCatalog
from utxolake.sources.sinks import Warehouse


def test_cli_backfill_sync_compare(spark, src, capsys):
    root = cq.scratch(spark).root
    export = MaterializedCatalog(src, f"{root}/source")
    for n in SOURCE_RELATIONS:
        export[n]
    common = ["--source", f"{root}/source", "--target", f"{root}/target", "--cluster-size", "5"]
    cli.main(["backfill", *common, "--tables", "tx,block,delegation,meta"])
    cli.main(["slot-sync", *common, "--cap", "600", "--grace", "3", "--delete", "10", "--tables", "tx,delegation"])
    cli.main(["epoch-sync", *common, "--tables", "delegation"])
    cli.main(["deep-compare", *common, "--tables", "tx,block,meta"])
    cli.main(["freshness", *common])
    out = capsys.readouterr().out
    assert "differ" not in out and "left_only" not in out and "right_only" not in out
    assert "equal" in out and "slot_lag" in out
    wh = Warehouse(spark, f"{root}/target")
    marks = {r["tablename"]: r for r in wh.last_index().collect()}
    assert {"tx", "block", "delegation", "source"} <= set(marks)
