from __future__ import annotations

import json

import pytest

from tracewright import cli


def record(i, status="success", **more):
    sample = {"id": i, "messages": [{"role": "user", "content": f"q {i}"}, {"role": "assistant", "content": '{"a": "t"}'}], "images": []}
    return {"sample_id": i, "status": status, "original_sample": sample, "cot_response": 'so\n```json\n{"a": "x"}\n```', "predicted_json": {"a": "x"}, **more}


def dataset(path, success, failed):
    path.mkdir()
    (path / "success_samples.json").write_text(json.dumps(success))
    (path / "failed_samples.json").write_text(json.dumps(failed))
    return str(path)


def read(path):
    return {n: json.loads((path / f"{n}_samples.json").read_text()) for n in ("success", "failed")}


def run(spark, *argv):
    args = cli.parser().parse_args(argv)
    args.run_tool(spark, args)


def test_merge_combine_convert(spark, tmp_path):
    diff = {"comparison_result": {"is_match": False, "differences": [{"field": "a", "type": "mismatch", "ground_truth": "t", "predicted": "x"}]}}
    one = dataset(tmp_path / "run", [record("a")], [record("b", "failed", **diff), record("c", "failed", **diff), record("d", "failed")])
    judged = dataset(tmp_path / "judge", [record("b", judge_result={"overturned": True})], [record("c", "failed", judge_result={"overturned": False}, **diff)])
    run(spark, "merge", "--run", one, "--judge", judged, "--output", str(tmp_path / "merged"))
    got = read(tmp_path / "merged")
    assert [sorted(r["sample_id"] for r in got[n]) for n in ("success", "failed")] == [["a", "b"], ["c", "d"]]
    summary = json.loads((tmp_path / "merged" / "merge_summary.json").read_text())
    assert (summary["judged_overturned"], summary["judged_upheld"], summary["untouched_failed"]) == (1, 1, 1)
    with pytest.raises(SystemExit):
        run(spark, "merge", "--run", one, "--judge", judged, "--output", one)

    run(spark, "combine", "--output", str(tmp_path / "all"), one, str(tmp_path / "merged"))
    assert json.loads((tmp_path / "all" / "combine_summary.json").read_text())["final_records"] == 8

    out = tmp_path / "train.jsonl"
    run(spark, "convert", "--input", str(tmp_path / "merged"), "--output", str(out), "--include-failed", "upheld", "--mix-ratio", "1.0")
    rows = [json.loads(line) for line in out.read_text().splitlines()]
    assert len(rows) == 3
    assert rows[0]["conversations"][1]["value"] == '<think>so</think>\n<answer>{\n  "a": "x"\n}</answer>'
    assert rows[2]["conversations"] == [{"from": "human", "value": "q c\n/no_think"}, {"from": "gpt", "value": '<answer>{\n  "a": "t"\n}</answer>'}]


DIFF = {"comparison_result": {"is_match": False, "differences": [{"field": "a", "type": "mismatch", "ground_truth": "t", "predicted": "x"}]}}


def lines(path, rows):
    path.write_text("\n".join(json.dumps(r) for r in rows))
    return str(path)


def test_judge_then_merge_combine_and_convert(spark, tmp_path):
    """Each tool's output is the next one's input, and no overturn is lost."""
    at = lambda name: str(tmp_path / name)
    one = dataset(tmp_path / "run", [record("a")], [record("b", "failed", **DIFF), record("c", "failed", **DIFF), record("d", "failed"), record("e", "failed", **DIFF)])
    yes, no = ('{"verdicts": ["odd", {"field": "a", "match": true}]}', '{"verdicts": [{"field": "a", "match": "true"}]}')
    replies = lines(tmp_path / "replies.json", [{"sample_id": "b", "outcome": "OK", "content": yes}, {"sample_id": "c", "outcome": "OK", "content": no}])
    fast = ["--qpm-limit", "60000", "--backoff-base", "0"]
    run(spark, "judge", "--input", one, "--replies", replies, "--output", at("judged"), *fast, "--limit", "3")
    summary = json.loads((tmp_path / "judged" / "judge_summary.json").read_text())
    assert (summary["judged"], summary["overturned"], summary["upheld"], summary["skipped_no_differences"], summary["skipped_resume"]) == (2, 1, 1, 1, 0)
    run(spark, "judge", "--input", one, "--replies", replies, "--output", at("judged"), *fast)  # goes on
    summary = json.loads((tmp_path / "judged" / "judge_summary.json").read_text())
    assert (summary["judged"], summary["terminal_error"], summary["skipped_resume"]) == (1, 1, 2)
    got = read(tmp_path / "judged")
    assert [[r["sample_id"] for r in got[n]] for n in ("success", "failed")] == [["b"], ["c", "e"]]
    assert got["success"][0]["judge_result"]["verdicts"] == ["odd", {"field": "a", "match": True}]
    assert got["success"][0]["predicted_json"] == {"a": "x"}
    run(spark, "merge", "--run", one, "--judge", at("judged"), "--output", at("merged"))
    merged = json.loads((tmp_path / "merged" / "merge_summary.json").read_text())
    assert (merged["judged_overturned"], merged["judged_upheld"], merged["judged_error"], merged["untouched_failed"], merged["final_success"]) == (1, 1, 1, 1, 2)
    run(spark, "combine", "--output", at("all"), at("merged"))
    mix = tmp_path / "mix.json"
    mix.write_text(json.dumps([{"conversations": [{"from": w, "value": f"{w} {i}"} for i, w in enumerate(["system", "human", "gpt", "human", "gpt"])], "images": []}]))
    run(spark, "convert", "--input", at("all"), "--output", at("train.json"), "--include-failed", "--mix", str(mix))
    rows = json.loads((tmp_path / "train.json").read_text())
    assert [len(r["conversations"]) for r in rows] == [2, 2, 2, 5]
    assert [t["value"] for t in rows[3]["conversations"]] == ["system 0", "human 1\n/no_think", "<answer>gpt 2</answer>", "human 3\n/no_think", "<answer>gpt 4</answer>"]
    told = json.loads((tmp_path / "convert_summary.json").read_text())
    assert (told["converted"], told["failed_used"], told["mixed_in"], told["total_samples"], told["no_cot_budget"], told["skipped"], told["failed_gt_recovered"]) == (2, 1, 1, 4, 2, 0, 1)


def test_polish_then_convert(spark, tmp_path):
    one = dataset(tmp_path / "run", [record("a"), record("b")], [])
    replies = lines(tmp_path / "replies.json", [{"sample_id": "a", "outcome": "OK", "content": '{"cot": " better ", "answer": {"a": "x"}}'}, {"sample_id": "b", "outcome": "OK", "content": '{"cot": "other", "answer": {"a": "y"}}'}])
    run(spark, "polish", "--input", one, "--replies", replies, "--output", str(tmp_path / "polished"), "--qpm-limit", "60000")
    run(spark, "convert", "--input", str(tmp_path / "polished"), "--output", str(tmp_path / "train.json"))
    rows = json.loads((tmp_path / "train.json").read_text())
    assert [r["conversations"][1]["value"] for r in rows] == ['<think>better</think>\n<answer>{\n  "a": "x"\n}</answer>']
    kept = read(tmp_path / "polished")["failed"][0]["polish_result"]
    assert (kept["applied"], kept["polished_cot"], kept["match_level"], kept["polished_answer"]) == (False, "other", "MISMATCH", {"a": "y"})


def test_missing_folders_are_errors(spark, tmp_path):
    one = dataset(tmp_path / "run", [record("a")], [])
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        run(spark, "merge", "--run", one, "--judge", str(tmp_path / "none"), "--output", str(tmp_path / "out"))


class Service:
    """A chat completion service on this machine, whose answers are scripted by the asked text."""

    def __init__(self):
        import http.server
        import threading

        calls = self.calls = []

        class Handler(http.server.BaseHTTPRequestHandler):
            def do_POST(self):  # noqa: N802
                body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
                asked = body["messages"][1]["content"][-1]["text"]
                calls.append((asked, self.headers["Authorization"], body["model"]))
                n = sum(c[0] == asked for c in calls)
                if "limited" in asked and n == 1:
                    self.send_response(429)
                    self.send_header("Retry-After", "0.01")
                    self.end_headers()
                    return
                if "gateway" in asked or "broken" in asked:
                    self.send_response(502 if "gateway" in asked else 400)
                    self.end_headers()
                    return
                text = '{"a": "t"}' if "good" in asked or "limited" in asked or ("later" in asked and n == 3) else "" if "empty" in asked else '{"a": "x"}'
                data = json.dumps({"choices": [{"message": {"content": f"so {text}" if text else ""}, "finish_reason": "stop"}], "usage": {"prompt_tokens": 3, "completion_tokens": 2}}).encode()
                self.send_response(200)
                self.end_headers()
                self.wfile.write(data)

            def log_message(self, *args):
                pass

        self.server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.server.server_port}/v1"


def test_generate_over_http(spark, tmp_path):
    service = Service()
    kinds = ["good", "limited", "gateway", "broken", "empty", "later", "wrong", "untrue"]
    samples = [{"id": k, "messages": [{"role": "user", "content": f"<image>{k} document"}, {"role": "assistant", "content": "none" if k == "untrue" else '{"a": "t"}'}], "images": []} for k in kinds]
    (tmp_path / "in.json").write_text(json.dumps(samples))
    options = ["--api-endpoint", service.url, "--api-key", "k", "--model", "m", "--qpm-limit", "60000", "--backoff-base", "0"]
    run(spark, "generate", "--input", str(tmp_path / "in.json"), "--output", str(tmp_path / "out"), *options)
    got = read(tmp_path / "out")
    assert {r["sample_id"]: r["attempts"] for r in got["success"]} == {"good": 1, "limited": 2, "later": 3}
    assert {r["sample_id"]: (r["attempts"], r["error_type"]) for r in got["failed"]} == {"gateway": (3, "GATEWAY_ERROR"), "broken": (1, "API_ERROR"), "empty": (1, "EMPTY_RESPONSE"), "wrong": (3, "MISMATCH"), "untrue": (1, "JSON_PARSE_ERROR")}
    wrong = next(r for r in got["failed"] if r["sample_id"] == "wrong")
    assert (wrong["predicted_json"], wrong["ground_truth"], wrong["match_level"]) == ({"a": "x"}, {"a": "t"}, "MISMATCH")
    assert {c[1:] for c in service.calls} == {("Bearer k", "m")}
    n = len(service.calls)
    summary = json.loads((tmp_path / "out" / "summary.json").read_text())
    assert (summary["total"], summary["success"], summary["total_http_requests"], sum(summary["quota"].values())) == (8, 3, n, n)
    assert summary["performance"]["total_requests"] == n
    assert summary["quota"]["initial"] == 7
    assert sum(len(p.read_text().splitlines()) for p in (tmp_path / "out" / "metrics.jsonl").glob("part-*")) == n
    run(spark, "generate", "--input", str(tmp_path / "in.json"), "--output", str(tmp_path / "out"), *options)
    assert len(service.calls) == n  # all done before
    assert sorted(r["sample_id"] for part in read(tmp_path / "out").values() for r in part) == sorted(kinds)


def test_network_failures_end_after_five_calls(spark):
    from tracewright.operators.model import Endpoint, http_model, replies

    df = spark.createDataFrame([(1, '[{"role": "user", "content": "q"}]')], "_ord long, messages string")
    calls = replies(df, http_model(Endpoint("http://127.0.0.1:9", "", "m", connect_timeout=0.5)))
    rows = sorted(calls.collect(), key=lambda r: r["attempt_no"])
    assert [(r["outcome"], r["last"]) for r in rows] == [("NETWORK_ERROR", False)] * 4 + [("NETWORK_ERROR", True)]


def test_compare(spark, tmp_path):
    (tmp_path / "pairs.json").write_text(json.dumps({"sample_id": "b", "reply": 'x {"a": 1}', "ground_truth": '{"a": 1.0}'}))
    run(spark, "compare", "--input", str(tmp_path / "pairs.json"), "--output", str(tmp_path / "compared"))
    assert spark.read.parquet(str(tmp_path / "compared")).select("comparison.match_level").first()[0] == "STRICT"
