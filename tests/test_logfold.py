"""The log fold against a plain sequential one, and both routes to outcomes against each other."""

import random
import re

from runlens import sources
from runlens.operators import logfold, outcome

KEY = re.compile(logfold.KEY)
FIXTURE = """[Mon 6 Jul 10:00:00 BST 2026] Skip already relaxed file: /r/epoch_1/m/repeat_1/predictions/1abc_A_model_1_relaxed.pdb
[Mon 6 Jul 10:00:01 BST 2026] Relaxing: /r/epoch_1/m/repeat_2/predictions/1abc_A_model_1_unrelaxed.pdb
Saved: /r/epoch_1/m/repeat_2/predictions/1abc_A_model_1_relaxed.pdb
Violations: 0.0
[Mon 6 Jul 10:00:09 BST 2026] Relaxing: /r/epoch_1/m/repeat_3/predictions/1abc_A_model_1_unrelaxed.pdb
ERROR processing: /r/epoch_1/m/repeat_3/predictions/1abc_A_model_1_unrelaxed.pdb
Minimization failed
second line is ignored
[Mon 6 Jul 10:00:12 BST 2026] Relaxing: /r/epoch_1/m/repeat_4/predictions/1abc_A_model_1_unrelaxed.pdb"""


def sequential(lines):
    """One record after the other, as a person would keep the book."""
    book, now = {}, None
    blank = lambda: {"status": None, "msg": None, "raw": None, "path": None, "events": 0}
    for line in lines:
        line = line.strip(" \t\r\n\x0b\x0c")
        mark = next((m for m in ("Relaxing:",) if m in line), None)
        if "Skip" in line and "relaxed" in line:
            body = line.split(":", 1)[1] if ":" in line else ""
            m = KEY.search(body)
            if m:
                rec = book.setdefault(m.groups()[:3], blank())
                if rec["status"] is None:
                    rec["status"] = "skipped_existing_relaxed"
                    rec["path"] = body[body.index("/") :].strip()
            continue
        kind = "running" if mark else "success" if line.startswith("Saved:") else "violations" if line.startswith("Violations:") else "error" if line.startswith("ERROR processing:") else None
        if kind in ("running", "success", "error"):
            token = {"running": "Relaxing:", "success": "Saved:", "error": "ERROR processing:"}[kind]
            body = line.split(token, 1)[1].strip()
            m = KEY.search(body)
            if m:
                now = m.groups()[:3]
                rec = book.setdefault(now, blank())
                rec["status"], rec["path"] = kind, body
        elif kind == "violations":
            if now:
                book[now]["raw"] = line.split("Violations:", 1)[1].strip()
        elif now and book[now]["status"] == "error" and book[now]["msg"] is None and line and not line.startswith("["):
            book[now]["msg"] = line
    return {(int(e), int(r), c): (v["status"], v["msg"], v["raw"], v["path"]) for (e, r, c), v in book.items()}


def random_log(rng):
    out = []
    for _ in range(rng.randrange(0, 40)):
        path = f"/r/epoch_{rng.randrange(2)}/m/repeat_{rng.randrange(2)}/predictions/{rng.choice('AB')}_model_1_{rng.choice(['un', ''])}relaxed.pdb"
        if rng.random() < 0.15:
            path = "/r/elsewhere/x.pdb"
        out.append(rng.choice([
            f"[10:00:00] Skip already relaxed file: {path}", f"[1:2] Relaxing: {path}", f"Saved: {path}", f"\tERROR processing: {path} ",
            f"Violations: {rng.choice(['1.5', 'abc', '', '2'])}", "some text", "  other text", "[bracket] text", "", "Skip relaxed", "Saved: nothing",
        ]))
    return out


def test_fixture(spark, tmp_path):
    (tmp_path / "a.log").write_text(FIXTURE)
    records = logfold.fold(sources.read_log_lines(spark, str(tmp_path / "a.log")))
    got = {r["repeat"]: (r["status"], r["error_message"], r["violations"]) for r in records.collect()}
    assert got == {1: ("skipped_existing_relaxed", None, None), 2: ("success", None, 0.0), 3: ("error", "Minimization failed", None), 4: ("running", None, None)}
    for skip_ok, good in ((False, 1), (True, 2)):
        r = outcome.summarize(outcome.log_flags(records, skip_ok), "epoch").first()
        assert (r["total"], r["success"], r["errors"], r["error_rate"], r["success_rate"]) == (4, good, 1, 0.25, good / 4)


def test_random_logs(spark):
    rng = random.Random(5)
    logs = [random_log(rng) for _ in range(120)]
    rows = [(f, i, line) for f, log in enumerate(logs) for i, line in enumerate(log)]
    got = {}
    for r in logfold.fold(spark.createDataFrame(rows, "file int, pos int, line string")).collect():
        got.setdefault(r["file"], {})[r["epoch"], r["repeat"], r["chain"]] = (r["status"], r["error_message"], r["violations_raw"], r["source_path"])
    assert got == {f: s for f, log in enumerate(logs) if (s := sequential(log))}


def test_empty(spark):
    assert logfold.fold(spark.createDataFrame([], "file string, pos int, line string")).count() == 0


def test_both_routes_agree(spark):
    """A consistent tree and log give the same rates."""
    rng = random.Random(3)
    un, re_, log = [], [], []
    for e in range(3):
        for r in range(5):
            base = f"/r/epoch_{e}/m/repeat_{r}/predictions/1abc_A_model_1_"
            un.append((base + "unrelaxed.pdb",))
            log.append(f"[t] Relaxing: {base}unrelaxed.pdb")
            if rng.random() < 0.6:
                re_.append((base + "relaxed.pdb",))
                log += [f"Saved: {base}relaxed.pdb", "Violations: 1"]
            else:
                log += [f"ERROR processing: {base}unrelaxed.pdb", "failed"]
    files = sources.outcome_listing(spark.createDataFrame(un, "path string"), spark.createDataFrame(re_, "path string"))
    lines = spark.createDataFrame([("f", i, x) for i, x in enumerate(log)], "file string, pos int, line string")
    a = outcome.summarize(files, "epoch").orderBy("epoch").collect()
    b = outcome.summarize(outcome.log_flags(logfold.fold(lines)), "epoch").orderBy("epoch").collect()
    assert a == b
