import os

from shelfwise.plans import cli, publish
from tests.conftest import SF_SMALL


def test_cli_land_rebuild_incremental_marts_report(spark, scratch):
    land, root, marts_out, tel = (os.path.join(scratch, n) for n in ("landing", "snap", "marts", "tel"))
    cli.main(["land", "--sf-dir", SF_SMALL, "--out", land])
    built = cli.main(["rebuild", "--sources", land, "--root", root, "--as-of", "2024-02-01", "--workers", "2",
                      "--telemetry", tel, "--run-id", "7"])
    assert all(p.startswith(built["build"]) for p in publish.current(spark, root).values())
    inc = cli.main(["incremental", "--sources", land, "--root", root, "--as-of", "2024-02-01", "--workers", "2"])
    assert all(p.startswith(inc["build"]) for p in publish.current(spark, root).values())
    out = cli.main(["marts", "--root", root, "--out", marts_out, "--as-of", "2024-02-01", "--names", "V07,V26,V23"])
    assert set(out["marts"]) == {"collection_value_branch_view", "genre_view"} and out["marts"]["genre_view"] > 0
    assert cli.main(["report", "--telemetry", tel])["runs"] == {"total_runs": 1, "successes": 1}
