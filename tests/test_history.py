"""Compacted days of event tables, and their merge into Silver day by day."""

import json

import pytest
from lake import write_sources

from degraus.plans import run as r
from degraus.plans import silver
from degraus.sources import external
from degraus.spec import REQUIRED_KEYS, TOPIC_INDICATORS, TOPIC_TARGETS
from degraus.streaming import events as ev
from degraus.streaming import history as h
from degraus.streaming.history import EventHistory

TABLE = "streaming_metas"


def target(day, **changes):
    event = {"evento": "atualizacao_meta", "timestamp": f"{day}T10:00:00", "sigla_uf": "SP", "ano": 2024,
             "meta_percentual": 80.0, "revisao": True, "fonte": "teste"}
    return json.dumps({**event, **changes})


@pytest.fixture
def lake(spark, tmp_path):
    return r.Lake(spark, str(tmp_path / "lake"), write_sources(tmp_path / "raw"))


def arrive(lake, tmp_path, batches, name="eventos", checkpoint="checkpoint"):
    """One batch per list of events, in order."""
    folder = tmp_path / "in"
    for topic in REQUIRED_KEYS:
        (folder / topic).mkdir(parents=True, exist_ok=True)
    for lines in batches:
        number = len(list((folder / TOPIC_TARGETS).iterdir()))
        (folder / TOPIC_TARGETS / f"{number:03d}.json").write_text("\n".join(lines) + "\n")
        stream = ev.read_event_files(lake.spark, {t: str(folder / t) for t in REQUIRED_KEYS}, files_per_batch=1)
        ev.ingest_available(stream, lake.bronze.folder, str(tmp_path / checkpoint), name=name)


def events(df):
    return sorted((x.sigla_uf, str(x.data), x.fluxo, x.lote, x.meta_percentual) for x in df.collect())


def folders(tmp_path):
    return sorted(str(p.relative_to(tmp_path)) for p in (tmp_path / "lake/bronze" / TABLE).glob("data=*/fluxo=*/lote=*"))


def test_ranges():
    assert h.with_numbers([[0, 3], [7, 7]], [5, 4, 9]) == [[0, 5], [7, 7], [9, 9]]
    assert h.with_numbers([], []) == [] and h.holds([[2, 4]], 3) and not h.holds([[2, 4]], 5)


def test_closed_days_are_compacted_once_and_replays_do_not_count_twice(lake, tmp_path, monkeypatch):
    days = ("2024-05-01", "2024-05-02", "2024-05-03")
    arrive(lake, tmp_path, [[target(d, sigla_uf=s, meta_percentual=float(i)) for d in days] for i, s in enumerate(("SP", "RJ", "MG"))])
    history = EventHistory(lake.spark, lake.bronze.folder, TABLE)
    before = events(history.read())
    assert len(before) == 9 and len(folders(tmp_path)) == 9

    # The run ends after the commit, before anything is removed.
    with monkeypatch.context() as m:
        m.setattr(EventHistory, "_remove", lambda self, gone: None)
        assert history.compact("2024-05-03") == ["data=2024-05-01", "data=2024-05-02"]
    assert len(folders(tmp_path)) == 9 and events(history.read()) == before
    assert history.compact("2024-05-03") == []  # only sweeps
    assert len(folders(tmp_path)) == 3 and events(history.read()) == before
    assert events(lake.bronze.read(TABLE)) == before

    # All batches run again: the days that were compacted hold them already.
    for f in (tmp_path / "in" / TOPIC_TARGETS).iterdir():
        f.rename(f.with_suffix(".again"))
    arrive_again = ev.read_event_files(lake.spark, {t: str(tmp_path / "in" / t) for t in REQUIRED_KEYS}, files_per_batch=1)
    ev.ingest_available(arrive_again, lake.bronze.folder, str(tmp_path / "lost"))
    assert len(folders(tmp_path)) == 9
    assert [x[:4] for x in events(history.read())] == [x[:4] for x in before]


def test_late_events_of_a_compacted_day(lake, tmp_path):
    arrive(lake, tmp_path, [[target("2024-05-01")], [target("2024-05-01", sigla_uf="RJ")], [target("x", sigla_uf="BA")],
                            [target("y", sigla_uf="CE")]])
    history = EventHistory(lake.spark, lake.bronze.folder, TABLE)
    assert history.compact("2024-06-01") == ["data=2024-05-01", h.NO_DAY]
    arrive(lake, tmp_path, [[target("2024-05-01", sigla_uf="MG"), target("2024-05-09", sigla_uf="AC")]])
    want = events(history.read())
    assert [x[0] for x in want] == ["AC", "BA", "CE", "MG", "RJ", "SP"]
    assert history.compact("2024-06-01") == ["data=2024-05-01"]  # the other day has one batch
    assert events(history.read()) == want and history.compact("2024-06-01") == []
    assert events(history.read(["data=2024-05-09"])) == [x for x in want if x[0] == "AC"]
    assert [f for f in folders(tmp_path) if "05-01" in f] == []
    # One folder a day, whatever it was made of.
    assert len(list((tmp_path / f"lake/bronze/{TABLE}_dias").glob("v-*/data=2024-05-01"))) == 1


def test_only_one_of_two_compactions_commits(lake, tmp_path, monkeypatch):
    arrive(lake, tmp_path, [[target("2024-05-01")], [target("2024-05-01", sigla_uf="RJ")]])
    history = EventHistory(lake.spark, lake.bronze.folder, TABLE)
    state = history._manifest()
    history.compact("2024-06-01")
    monkeypatch.setattr(EventHistory, "_manifest", lambda self: state)
    monkeypatch.setattr(EventHistory, "_batches", lambda self, days: (
        {"data=2024-05-01": {"fluxo=eventos": {0: "x", 1: "y"}}}, []))
    monkeypatch.setattr(EventHistory, "read", lambda self, days: lake.spark.createDataFrame([(1, "2024-05-01")], "a INT, data STRING"))
    with pytest.raises(h.PublicationConflict):
        history.compact("2024-06-01")


def merged(lake):
    """Merge the events and name the days that were read."""
    read, asked = EventHistory.read, []

    def spy(self, days=None):
        df = read(self, days)
        if days is not None and self.table == TABLE:
            asked.append((sorted(days), len(df.inputFiles())))
        return df

    with pytest.MonkeyPatch.context() as m:
        m.setattr(EventHistory, "read", spy)
        result = r.build_silver(lake)["meta_streaming"]
    got = sorted(map(str, lake.silver.read("meta_streaming").drop("dt_processamento").collect()))
    whole = silver.target_events(lake.bronze.read(TABLE), keep=("data",))
    order = lake.silver.read("meta_streaming").drop("dt_processamento").columns
    assert got == sorted(map(str, whole.select(*order).collect()))
    return result, asked


def test_silver_reads_only_the_days_that_changed(lake, tmp_path):
    arrive(lake, tmp_path, [[target(f"2024-05-0{d}", sigla_uf=s) for d in range(1, 6)] for s in ("SP", "RJ")])
    result, asked = merged(lake)
    assert result == {"status": "sucesso", "dias": 5} and len(asked[0][0]) == 5
    # A later event for a key of one day, a new key of another, and an event of another year on that day.
    arrive(lake, tmp_path, [[target("2024-05-02", meta_percentual=99.0), target("2024-05-04", sigla_uf="MG"),
                             target("2024-05-04", sigla_uf="MG", ano=2025)]])
    result, asked = merged(lake)
    assert result["dias"] == 2 and asked == [(["data=2024-05-02", "data=2024-05-04"], 6)]
    # Nothing new, and a compaction: nothing is read.
    assert merged(lake) == ({"status": "sucesso", "dias": 0}, [])
    r.compact_events(lake, "2024-05-05")
    assert merged(lake) == ({"status": "sucesso", "dias": 0}, [])
    # The run broke off before the days were noted: they are merged once more.
    (tmp_path / "lake/silver/_lotes/meta_streaming.json").unlink()
    assert merged(lake)[0]["dias"] == 5
    # A batch that was written anew is merged again.
    arrive(lake, tmp_path, [[target("2024-05-05", sigla_uf="BA")]], checkpoint="other")
    assert merged(lake)[0]["dias"] >= 1


def test_a_run_with_events_publishes_their_monitoring(lake, tmp_path):
    arrive(lake, tmp_path, [[target("2024-05-01"), target("2024-05-02")]])
    result = r.run(lake)
    assert result.published
    row = lake.gold.read("monitoramento_streaming").first()
    assert (row.topico, row.total_eventos) == ("metas", 2)


def test_broker_batches_start_by_number_or_by_time(spark):
    """The options that the connector reads; without it a stream cannot be opened here."""
    seen = {}

    class Reader:
        def format(self, name):
            seen["format"] = name
            return self

        def options(self, **options):
            seen.update(options)
            return self

        def load(self):
            return spark.createDataFrame([("t", b"{}")], "topic STRING, value BINARY")

    class Session:
        readStream = Reader()

    df = external.read_broker(Session(), "b:1", ["x", "y"], per_batch=500, at_least=10, wait="3 seconds")
    assert df.columns == ["topico", "valor"] and seen["format"] == "kafka" and seen["subscribe"] == "x,y"
    assert (seen["maxOffsetsPerTrigger"], seen["minOffsetsPerTrigger"], seen["maxTriggerDelay"]) == (500, 10, "3 seconds")
    seen.clear()
    external.read_broker(Session(), "b:1", ["x"], wait="3 seconds")
    assert "minOffsetsPerTrigger" not in seen and "maxTriggerDelay" not in seen
    assert TOPIC_INDICATORS in REQUIRED_KEYS
