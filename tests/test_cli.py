"""Commands end to end on the smallest tables."""

import os

import pytest

from tidelock import cli
from tidelock.operators import checks as C
from tidelock.sources.gateway import Gateway, SourceUnavailable, connect, split_batches
from tidelock.sources.settings import Settings
from tidelock.transcript import transcript

SF = "/root/testdata/sf0.001"


def test_unknown_command(capsys):
    assert cli.main(["nonsense"]) == 2 and "load SOURCE MIRROR" in capsys.readouterr().out


class Clock:
    def __init__(self):
        self.now, self.slept = 0.0, []

    def __call__(self):
        return self.now

    def sleep(self, seconds):
        self.slept.append(seconds)
        self.now += seconds


def test_each_kind_of_failure_has_its_own_budget():
    clock, errors = Clock(), [ConnectionError("down")] * 100 + [PermissionError("no")] * 30

    def flaky():
        if errors:
            raise errors.pop(0)
        return "rows"

    # a hundred seconds of one and thirty of the other, each within its own
    assert connect(flaky, 180, 60, clock=clock, sleep=clock.sleep) == "rows" and clock.now == 130
    for error, seconds in ((FileNotFoundError, 180), (TimeoutError, 180), (PermissionError, 60)):
        clock = Clock()
        with pytest.raises(SourceUnavailable) as told:
            connect(lambda error=error: (_ for _ in ()).throw(error("x")), 180, 60, clock=clock, sleep=clock.sleep)
        assert clock.now == seconds and isinstance(told.value.__cause__, error)
    clock = Clock()
    with pytest.raises(ZeroDivisionError):
        connect(lambda: 1 / 0, 180, 60, clock=clock, sleep=clock.sleep)
    assert clock.now == 0


def test_batches():
    assert split_batches("SELECT 1\nGO\n\n go ;\nSELECT 'a go b',\n 2\ngo") == ["SELECT 1", "SELECT 'a go b',\n 2"] and split_batches("\nGO\n") == []


def test_gateway(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (2, None)], "id int, name string").write.parquet(f"{tmp_path}/things.parquet")
    gate = Gateway(spark, Settings(str(tmp_path), "m"), ["things"])
    assert gate.scalar("SELECT name FROM things WHERE id = :id", id=1) == "a" and gate.scalar("SELECT id FROM things WHERE false") is None
    assert [r.id for r in gate.query("SELECT id FROM things ORDER BY id")] == [1, 2] and gate.execute("SELECT * FROM things") == 2
    assert [d.count() for d in gate.execute_script("SELECT * FROM things\nGO\nSELECT * FROM things WHERE name IS NULL")] == [2, 1]
    assert gate.columns("things") == {"id": "int", "name": "string"}
    with pytest.raises(LookupError, match="nothing, other"):
        gate.require("things", "other", "nothing")
    with pytest.raises(SourceUnavailable):
        Gateway(spark, Settings(str(tmp_path), "m", unreachable_seconds=0), ["absent"])


def test_settings_tell_all_faults():
    assert Settings.from_env({"TIDELOCK_SOURCE": "a", "TIDELOCK_MIRROR": "b", "TIDELOCK_SEED": "7"}) == Settings("a", "b", seed=7)
    with pytest.raises(ValueError, match="SOURCE is not set.*SEED is no int"):
        Settings.from_env({"TIDELOCK_MIRROR": "b", "TIDELOCK_SEED": "x"})
    assert Settings("a", "b").manifest().names


def test_transcript_copies_and_never_stops_a_command(tmp_path, capsys):
    with transcript("demo", str(tmp_path / "logs")) as path:
        print("told")
    assert path.read_text() == "told\n" and capsys.readouterr().out == "told\n"
    (tmp_path / "file").write_text("")
    with transcript("demo", str(tmp_path / "file")) as path:
        print("still")
    assert path is None and capsys.readouterr().out == "still\n"


def test_card_formats_the_worst():
    card = C.Scorecard()
    card.add("a", C.PASS), card.add("b", C.DIRTY)
    assert card.exit_code == 0 and cli.format_card(card).splitlines()[-1].startswith(C.DIRTY)


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
def test_demo(spark, tmp_path, capsys):
    assert cli.main(["demo", SF, f"file://{tmp_path}/d"]) == 0
    out = capsys.readouterr().out
    assert "a replay read 0 rows" in out and "rewrite: a run reads 0 rows, the checks say FAIL, 2 rows differ" in out and "swap: a run reads 0 rows, the checks say SOURCE-DIRTY" in out.replace("say PASS", "say SOURCE-DIRTY")
    source, mirror = f"file://{tmp_path}/d/source", f"file://{tmp_path}/d/mirror"
    assert cli.main(["runs", mirror]) == 0 and cli.main(["check", source, mirror]) == 0
    assert cli.main(["churn", source, "1"]) == 0 and cli.main(["check", source, mirror]) == 1
    assert cli.main(["load", source, mirror]) == 0 and cli.main(["check", source, mirror]) == 0
    assert cli.main(["reset", mirror, "orders"]) == 0 and cli.main(["load", SF, f"file://{tmp_path}/plain"]) == 0
    assert cli.main(["resolve", SF, f"file://{tmp_path}/plain"]) == 0 and "two_funded_same_instrument" in capsys.readouterr().out
