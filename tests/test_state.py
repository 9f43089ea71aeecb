"""The newest row of each key as state, over late, repeated and restarted batches."""

import json
import time

from siteweave.streaming import state


def test_newest_rows_as_state(spark, tmp_path):
    folder, cp, out = tmp_path / "in", str(tmp_path / "cp"), []
    folder.mkdir()
    write = lambda name, rows: (folder / name).write_text("\n".join(json.dumps(r) for r in rows))

    def run():
        changes = state.newest_rows(state.new_records(spark, str(folder), "k string, ts long, x string"), "k", "ts")
        keep = lambda df, n: out.append(sorted((r["k"], r["ts"], r["x"]) for r in df.collect()))
        changes.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", cp).trigger(availableNow=True).start().awaitTermination()

    table = lambda: {r["k"]: (r["ts"], r["x"]) for r in state.read_newest(spark, cp).collect()}
    write("a.json", [{"k": "a", "ts": 1, "x": "old"}, {"k": "b", "ts": 5, "x": "b"}, {"k": None, "ts": 9, "x": "no key"}, {"k": "n", "ts": None, "x": "no time"}])
    run()
    assert table() == {"a": (1, "old"), "b": (5, "b"), "n": (None, "no time")}
    time.sleep(1.1)
    write("b.json", [{"k": "a", "ts": 2, "x": "new"}, {"k": "b", "ts": 4, "x": "late"}, {"k": "a", "ts": 2, "x": "tie"}, {"k": "b", "ts": 5, "x": "again"}])
    run()
    run()  # nothing new
    assert table() == {"a": (2, "new"), "b": (5, "b"), "n": (None, "no time")}
    assert [x for x in out if x] == [[("a", 1, "old"), ("b", 5, "b"), ("n", None, "no time")], [("a", 2, "new")]]


def test_idle_keys_are_forgotten(spark, tmp_path):
    folder, cp = tmp_path / "in", str(tmp_path / "cp")
    folder.mkdir()

    def run():
        changes = state.newest_rows(state.new_records(spark, str(folder), "k string, ts long"), "k", "ts", keep_ms=1)
        changes.writeStream.outputMode("update").foreachBatch(lambda df, n: df.count()).option("checkpointLocation", cp).trigger(once=True).start().awaitTermination()

    (folder / "a.json").write_text('{"k": "a", "ts": 1}')
    run()
    time.sleep(1.1)
    (folder / "b.json").write_text('{"k": "b", "ts": 1}')
    run()
    assert "a" not in {r["k"] for r in state.read_newest(spark, cp).collect()}
