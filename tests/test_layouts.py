"""Raw files of many layouts: few plans, decisions by file, rejects by record."""

import json
import os
import re

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import clean as CL
from ledgerlens.sources import files as FI
from ledgerlens.sources import layouts as LA


def _write(folder, files):
    out = []
    for name, text in files.items():
        out.append(os.path.join(folder, name))
        with open(out[-1], "w") as f:
            f.write(text)
    return out


FLAT = [{"event": "borrow", "user": "0xA", "amount": 12345678901234567890123, "time": 1600000000, "hash": "h1"},
        {"event": " Supply\t", "user": "0xB", "amount": 1.5, "time": "2020-09-13 12:26:41", "hash": "h2"}]


def test_formats_and_layouts(spark, tmp_dir):
    paths = _write(tmp_dir, {"a.csv": "event_type;timestamp\nMint;1\n", "b": '\n  [{"x": 1}]', "c.dat": "\n{\n", "d": "x,y\n", "e": "nothing\n", "f.json": "42", "g.json": "",
                             "h.csv": '"event_type","timestamp","account, main","token","amount"\n', "i j.JSON": "{}"})
    formats = {os.path.basename(r.path): r.format for r in FI.infer_file_format(spark, paths).collect()}
    assert formats == {"a.csv": "csv", "b": "json", "c.dat": "json", "d": "csv", "e": "unknown", "f.json": "json", "g.json": "json", "h.csv": "csv", "i j.JSON": "json"}
    groups, bad = LA.layouts(spark, paths)
    assert {k: [os.path.basename(p) for p in v] for k, v in groups.items()} == {
        ("csv", ";", ("event_type", "timestamp")): ["a.csv"], ("json", "array"): ["b"], ("json", "object"): ["c.dat", "i j.JSON"], ("csv", ",", ("x", "y")): ["d"],
        ("csv", ",", ("event_type", "timestamp", "account, main", "token", "amount")): ["h.csv"]}
    assert [(os.path.basename(p), e.split(":")[0].split(" for ")[0]) for p, e, _ in bad] == [("e", "Unsupported file format"), ("f.json", "not a JSON array or object"), ("g.json", "empty file")]


def test_decisions_are_made_by_file(spark, tmp_dir):
    """A file with `wallet` beside one with `account`, one without event names beside one with."""
    paths = _write(tmp_dir, {
        "a.json": json.dumps(FLAT), "b.json": json.dumps([{"event_type": "Redeem", "account": "0xC", "user": "0xZ", "timestamp": 1600000002, "tx_hash": "h3"}]),
        "c.json": json.dumps([{"borrower": "0xD", "timestamp": 1600000003, "hash": "h4"}, {"borrower": "0xE", "timestamp": 1600000004, "hash": "h5"}]),
        "d.csv": "minter,timestamp,amount,token,hash\n0xF,1600000005,7,0xT,h6\n", "e.json": json.dumps({"type": "repay", "payer": "0xG", "date": 1600000006, "hash": "h7", "asset": {"id": 5}})})
    tx, rejected = FI.load_and_process(spark, paths)
    got = {r.transaction_hash: (r.event_type, r.account, r.amount) for r in CL.clean_transactions(tx).collect()}
    assert got == {"h1": ("Borrow", "a", pytest.approx(1.2345678901234568e22)), "h2": ("Mint", "b", 1.5), "h3": ("Redeem", "c", None), "h4": ("Borrow", "d", None),
                   "h5": ("Borrow", "e", None), "h6": ("Mint", "f", 7.0), "h7": ("RepayBorrow", "g", None)}
    assert rejected.count() == 0
    assert {r.timestamp.second for r in tx.where("transaction_hash = 'h2'").collect()} == {41}


def test_bad_records_are_rejected_one_by_one(spark, tmp_dir):
    head = "event_type,timestamp,account,amount,token\n"
    paths = _write(tmp_dir, {"a.csv": head + 'Mint,1,a,5,"x,y"\nMint,2,b,5,x,more\nMint,3,c\nMint,4,d,5,x\n', "b.csv": head + "Mint,5,e,5,x\n", "c.json": '[{"event_type": "Mint"', "d.json": '{"deposits": 7}',
                             "e.json": json.dumps({"deposits": [], "borrows": []})})
    tx, rejected = FI.load_and_process(spark, paths)
    assert sorted((r.account, r.token or "") for r in tx.where("account is not null").collect()) == [("a", "x,y"), ("c", ""), ("d", "x"), ("e", "x")]
    got = sorted((os.path.basename(r.path), (r.record or "")[:16]) for r in rejected.collect())
    assert [g for g in got if g[0] == "a.csv"] == [("a.csv", "Mint,2,b,5,x,mor")]
    assert {g[0] for g in got} >= {"a.csv", "c.json"} and "e.json" not in {g[0] for g in got}
    with pytest.raises(FI.UnsupportedFile):
        FI.load_and_process(spark, paths[2:3])


def test_plans_follow_layouts_not_files(spark, tmp_dir):
    files = {f"{i}.csv": f"event_type,timestamp,account,amount,token\nMint,{i},w{i},1,t\n" for i in range(40)}
    files |= {f"{i}.json": json.dumps([{"event_type": "Mint", "timestamp": i, "account": f"v{i}"}]) for i in range(40)}
    groups, _ = LA.layouts(spark, _write(tmp_dir, files))
    raw = LA.parse(spark, groups)
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan", plan)) == 2 and raw.count() == 80
    tx, _ = FI.load_and_process(spark, [p for ps in groups.values() for p in ps])
    assert tx.agg(F.countDistinct("account")).first()[0] == 80


def test_liquidators_are_kept_on_demand(spark, tmp_dir):
    doc = {"liquidations": [{"account": {"id": "0xA"}, "asset": {"id": "t"}, "liquidator": {"id": "0xL"}, "timestamp": "1", "hash": "h"}]}
    p = _write(tmp_dir, {"n.json": json.dumps(doc)})
    assert FI.load_and_process(spark, p, keep_liquidator=True)[0].first().liquidator == "l"
    assert "liquidator" not in FI.load_and_process(spark, p)[0].columns


def test_first_records_need_no_python_and_skip_blank_lines(spark, tmp_dir, monkeypatch):
    """Many files: no Python worker for each; a file that begins with many blank lines is read on."""
    files = {f"{i}.txt": f" \t\n\n{{\"a\": {i}}}\nmore,{i}\n" for i in range(40)} | {"late.txt": "\n" * (LA.HEAD_RECORDS + 5) + "[1]\n", "blank.txt": "\n \n"}
    paths = _write(tmp_dir, files)
    real, used = type(spark.range(1)).mapInArrow, []
    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", lambda df, *a, **k: used.append(len(df.inputFiles())) or real(df, *a, **k))
    heads = {os.path.basename(p): h for p, h in LA.first_lines(spark, paths).items()}
    assert heads == {f"{i}.txt": f'{{"a": {i}}}' for i in range(40)} | {"late.txt": "[1]"}
    assert used == [2]


def test_files_do_not_each_take_a_task_to_write(spark, tmp_dir):
    from ledgerlens.sources import sinks as SK
    t = spark.range(300).selectExpr("'Mint' AS event_type", "timestamp_seconds(id) AS timestamp", "concat('w', id) AS account", "concat('h', id) AS transaction_hash",
                                    "'t' AS token", "'c' AS ctoken", "1.5D AS amount")
    seen = []

    class Tracker:
        def __init__(self):
            self.group = "write-by-event"

        def __enter__(self):
            spark.sparkContext.setJobGroup(self.group, self.group)

        def __exit__(self, *a):
            st = spark.sparkContext.statusTracker()
            for j in st.getJobIdsForGroup(self.group):
                for s in st.getJobInfo(j).stageIds:
                    info = st.getStageInfo(s)
                    seen.append(info.numTasks if info else 0)
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    with Tracker():
        SK.write_json_by_event(t, f"{tmp_dir}/keyed", 3)
    docs = [json.load(open(os.path.join(d, f))) for d, _, fs in os.walk(f"{tmp_dir}/keyed") for f in fs if f.startswith("part-")]
    assert len(docs) > 60 and sorted(e["hash"] for d in docs for e in d["Mint"]) == sorted(f"h{i}" for i in range(300))
    assert max(seen) < 60


def test_a_json_file_is_one_record_with_exact_numbers(spark, tmp_dir):
    """No file is gone back to for the text of a number; records have many lines, numbers keep their digits."""
    rows = '[\n {"event_type": "Mint", "amount": 1.50, "hash": "h1",\n "timestamp": 1},\n {"event_type": "Mint", "amount": 12345678901234567890.10, "hash": "h2", "timestamp": 2}\n]\n'
    paths = _write(tmp_dir, {"a.json": rows, "b.json": '{"Mint":\n [{"amount": 2.00, "hash": "h3"},\n {"amount": 3e2, "hash": "h4"}]}', "c.json": "[{\n"})
    raw = LA._read_json(spark, paths)
    assert "multiLine" not in raw._jdf.queryExecution().analyzed().relation().options().toString()
    groups, _ = LA.layouts(spark, paths)
    got = LA.parse(spark, groups)
    assert {r.hash: r.amount for r in got.where("hash is not null").collect()} == {"h1": "1.50", "h2": "12345678901234567890.10", "h3": "2.00", "h4": "3e2"}
    assert [r._corrupt_record for r in got.where("_corrupt_record is not null").collect()] == ["[{\n"]
