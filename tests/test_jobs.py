"""The command-line jobs run end to end on small landed files."""

import json
import os

from chanlake.plans import jobs


def test_clean_job(spark, workdir):
    src = workdir.replace("file:", "") + "/landed"
    os.makedirs(src, exist_ok=True)
    records = [
        {"Group ID": 1, "Message IDs": [3, 2], "Text": "Helloo", "Message": "Helloo 😀 http://x.y/z?a=1",
         "Date": "2024-01-01T10:00:00+03:00", "Sender ID": 5, "Media Path": ["m/3.jpg"], "Channel": " shop "},
        {"Group ID": 4, "Message IDs": [4], "Text": None, "Message": None, "Date": None, "Sender ID": 0,
         "Media Path": None, "Channel": "shop"},
    ]
    with open(src + "/shop.json", "w") as f:
        json.dump(records, f, ensure_ascii=False, indent=4)
    out = workdir + "/clean"
    jobs.clean(spark, src + "/*.json", out, "2025-01-01 00:00:00", fmt="json")
    rows = {r["group_id"]: r for r in spark.read.json(out).collect()}
    assert rows[1]["message"] == "Helo" and rows[1]["emojis"] == "😀"
    assert rows[1]["links"] == ["http://x.y/z?a=1"] and rows[1]["channel"] == "shop"
    assert rows[4]["message"] == "No Mesage" and rows[4]["media_path"] == ["No Media"]
    assert rows[4]["message_date"].startswith("2025-01-01T00:00:00")


def test_cli_parses(spark, workdir):
    import pytest
    with pytest.raises(SystemExit):
        jobs.main(["clean", "--input", "x"])           # missing required options


def test_listen_job_once(spark, workdir):
    src = workdir.replace("file:", "") + "/live"
    os.makedirs(src, exist_ok=True)
    msgs = [
        {"channel": "c", "id": 11, "grouped_id": 900, "date": "2024-01-01 00:00:00", "message": "a",
         "text": "a", "sender_id": 5},
        {"channel": "c", "id": 12, "grouped_id": 900, "date": "2024-01-01 00:00:03", "message": "b",
         "text": "", "sender_id": 5},
        {"channel": "c", "id": 20, "grouped_id": None, "date": "2024-01-01 01:00:00", "message": "later",
         "text": "later", "sender_id": 6},
    ]
    with open(src + "/batch-1.json", "w") as f:
        f.write("\n".join(json.dumps(m) for m in msgs))
    sink = workdir + "/albums"
    jobs.listen(spark, src, sink, workdir + "/ckpt", "1 minute", fmt="json", once=True)
    rows = [(r["group_id"], r["message_ids"], r["message"]) for r in spark.read.parquet(sink).collect()]
    assert rows == [(900, [11, 12], "a\nb")]          # the later message still waits for its gap


def test_listen_channels_media_and_bad_dates(spark, workdir):
    src = workdir.replace("file:", "") + "/live"
    os.makedirs(src, exist_ok=True)
    base = {"grouped_id": 7, "text": "", "sender_id": 1}
    msgs = [
        {**base, "channel": "c", "id": 1, "date": "2024-01-01 00:00:00", "message": "a", "media_kind": "photo"},
        {**base, "channel": "c", "id": 2, "date": "2024-01-01 00:00:02", "message": "b", "media_kind": "document",
         "mime_type": "image/png"},
        {**base, "channel": "c", "id": 3, "date": "bad", "message": "lost?"},
        {**base, "channel": "other", "id": 4, "date": "2024-01-01 00:00:00", "message": "not listed"},
        {**base, "channel": "c", "id": 9, "grouped_id": 8, "date": "2024-01-01 02:00:00", "message": "later"},
    ]
    with open(src + "/m.json", "w") as f:
        f.write("\n".join(json.dumps(m) for m in msgs))
    sink = workdir + "/albums"
    jobs.listen(spark, src, sink, workdir + "/ckpt", "1 minute", once=True, channels=["c"])
    rows = [(r["channel"], r["message_ids"], r["media_path"]) for r in spark.read.parquet(sink).collect()]
    assert rows == [("c", [1, 2], ["media/c/1.jpg", "media/c/2.png"])]
    assert [r["id"] for r in spark.read.parquet(sink + "_rejected").collect()] == [3]


def test_clean_job_reads_json_lines(spark, workdir):
    src = workdir.replace("file:", "") + "/lines"
    os.makedirs(src, exist_ok=True)
    with open(src + "/shop.json", "w") as f:
        for i in range(50):
            f.write(json.dumps({"Group ID": i, "Message": f"m{i}", "Date": "2024-01-01T10:00:00", "Channel": "c"}) + "\n")
    jobs.clean(spark, src + "/*.json", workdir + "/out", "2025-01-01 00:00:00")
    assert spark.read.parquet(workdir + "/out").count() == 50
