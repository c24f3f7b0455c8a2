"""HTTP statuses, the command line's flow and exit codes, safe output, isolation."""

import json
import os
import sys
import threading
import time
import urllib.error
import urllib.request
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from strandline.functions.config import QueryApi
from strandline.functions.times import utc_now
from strandline.operators import query as Q
from strandline.service import cli
from strandline.service.http import server
from strandline.service.isolation import Killed, isolated
from strandline.service.output import OutputError, emit, redact
from strandline.sources.hot import ParquetHotTable
from strandline.streaming.scheduler import Registry


@pytest.fixture
def web(spark):
    registry = Registry()
    registry.run("j", "export", lambda: 1)
    s = server(QueryApi(True, "127.0.0.1:0", ("k1", "k2")), Q.Service(spark, {"t": spark.range(5).toDF("a")}, max_rows=3, timeout_seconds=30), registry)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_address[1]}"
    s.shutdown()
    s.server_close()


def ask(url, body=None, key="k2"):
    data = None if body is None else body if isinstance(body, bytes) else json.dumps(body).encode()
    try:
        with urllib.request.urlopen(urllib.request.Request(url, data, {"Authorization": f"Bearer {key}"}), timeout=60) as f:
            return f.status, json.load(f)
    except urllib.error.HTTPError as e:
        return e.code, json.load(e)


def test_http(web):
    assert ask(web + "/healthz", key="")[0] == 200
    assert ask(web + "/admin/jobs", key="no")[0] == 401
    assert ask(web + "/admin/jobs")[1]["jobs"][0]["job"] == "j"
    assert ask(web + "/query", {"sql": "SELECT 1"}, key="no")[0] == 401
    status, got = ask(web + "/query", {"sql": "SELECT a FROM t ORDER BY a", "max_rows": 99})
    assert status == 200 and [int(r["a"]) for r in got["rows"]] == [0, 1, 2]
    assert got["truncated"] and ask(web + "/query", {"sql": "SELECT a FROM t", "max_rows": 1})[1]["rowCount"] == 1
    for body, code in [({"sql": "DROP TABLE t"}, 400), ({"sql": "SELECT nope FROM t"}, 422), (b"{", 400), ({}, 400), ({"sql": "SELECT 1", "max_rows": -1}, 400), ({"sql": "SELECT count(*) FROM range(100000) a JOIN range(100000) b ON a.id * b.id % 7 = 9", "timeout_seconds": 0.05}, 408)]:
        assert ask(web + "/query", body)[0] == code, body
    assert ask(web + "/other")[0] == 404


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    now = utc_now()
    rows = [(i + 1, (now - timedelta(days=d)).replace(tzinfo=None).isoformat(sep=" ")) for i, d in enumerate([3, 3, 2, 2, 2])]
    ParquetHotTable(spark, f"{tmp_path}/hot", "id").replace(spark.createDataFrame(rows, "id long, t string").select("id", F.col("t").cast("timestamp_ntz").alias("created_at")))
    (tmp_path / "c.yml").write_text(json.dumps({"jobs": [{"name": "j", "table": f"{tmp_path}/hot", "prefix": f"{tmp_path}/archive", "export_rows": 4, "delete_sleep_ms": 0}]}))

    def run(*args):
        code = cli.main(["--config", f"{tmp_path}/c.yml", *args], spark)
        got = capsys.readouterr()
        return code, got.out, got.err

    assert run("check")[0] == 0
    assert json.loads(run("run", "j", "--dry-run")[1])["rows"] == 4
    assert [json.loads(run("run", "j")[1])["rows"] for _ in range(2)] == [4, 1]
    assert len([x for x in run("compact", "j")[1].splitlines() if json.loads(x)["status"] == "ok"]) == 2
    code, out, err = run("query", "SELECT count(*) AS n FROM j", "--format", "csv", "--no-header")
    assert (code, out.strip()) == (0, "5")
    assert "first 2 rows" in run("query", "SELECT id FROM j", "--max-rows", "2")[2]
    assert json.loads(run("purge", "j")[1])["deleted"] == 5
    assert json.loads(run("status")[1])["lag"] == 0
    assert run("query", "DROP TABLE j")[0] == 3 and run("query", "SELECT x FROM j")[0] == 3
    assert run("run", "other")[0] == 2 and run("compact", "j", "--dt", "x")[0] == 2
    monkeypatch.chdir(tmp_path)
    assert run("query", "SELECT 1 AS a", "--output", "r.json")[0] == 0 and json.loads((tmp_path / "r.json").read_text())["rowCount"] == 1
    assert run("query", "SELECT 1 AS a", "--output", "r.json")[0] == 2


def test_output_stays_below_its_folder(tmp_path):
    os.symlink("/tmp", tmp_path / "link")
    for bad in ("/tmp/x", "../x", "link/x", "none/x"):
        with pytest.raises(OutputError):
            emit("x", bad, str(tmp_path))
    emit("x", "new", str(tmp_path))
    assert (tmp_path / "new").stat().st_mode & 0o777 == 0o600


def test_redaction():
    got = redact("read s3a://b/p/dt=1/x.parquet with password=abc and K9", ("K9",))
    assert got == "read [location] with password=[redacted] and [redacted]"


def test_isolation_ends_a_deaf_process():
    began = time.time()
    with pytest.raises(Killed):
        isolated([sys.executable, "-c", "import signal, time; signal.signal(15, signal.SIG_IGN); time.sleep(60)"], 1.0)
    assert time.time() - began < 10
    assert isolated([sys.executable, "-c", "print(5)"], 30).stdout == "5\n"
