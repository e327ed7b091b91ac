from test_jobs import landing_root  # noqa: F401

from catalog_sync.__main__ import main
from catalog_sync.sources.snapshots import SnapshotStore


def test_commands_end_to_end(spark, landing_root, tmp_path, rows, capsys):  # noqa: F811
    at = ["--store", str(tmp_path / "store")]
    source = ["--landing", landing_root]
    main(["build", *at, *source, "--year", "2020", "--csv", str(tmp_path / "csv")])
    store = SnapshotStore(spark, str(tmp_path / "store"))
    assert rows(store.table("movies"), "id") == [(1,), (2,), (7,)]
    assert "validation_error" in capsys.readouterr().out

    main(["search", *at, *source, "released"])
    assert "1. released (2024-05-01) - ID: 10" in capsys.readouterr().out
    main(["search", *at, *source, "released", "--select", "1"])
    main(["refresh", *at, *source, "--id", "7"])
    main(["add-new", *at, *source, "--period", "day"])
    main(["report", *at])
    assert rows(store.table("movies"), "id") == [(1,), (10,), (2,), (7,)]

    main(["index-titles", *at])
    capsys.readouterr()
    main(["titles", *at, "RELEASED"])
    assert '"id":10' in capsys.readouterr().out

    other = ["--store", str(tmp_path / "other")]
    main(["load-csv", *other, "--csv", str(tmp_path / "csv"), "--initial"])
    loaded = SnapshotStore(spark, str(tmp_path / "other"))
    assert rows(loaded.table("movies"), "id") == [(1,), (2,), (7,)]
