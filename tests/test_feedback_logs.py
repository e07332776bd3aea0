"""Log lines of every shape that the apps write."""

from hoardline import schemas
from hoardline.sources.files import read_json_lines
from hoardline.streaming.feedback import feedback_rows, split_log, sync_feedback, verified_dataset

LINES = [
    '{"timestamp": 1, "filename": "a.jpg", "original_prediction": "greek", "original_confidence": "0.91", "corrected_label": "roman"}',
    '{"timestamp": "2026-01-01T00:00:00", "filename": "a.jpg", "label": "greek", "confidence": 0.5, "top_3": [["greek", 0.5]]}',
    '{"timestamp": 1, "filename": "a.jpg", "type": "correction", "original_prediction": "greek", "corrected_label": "islamic"}',
    '{"timestamp": 1, "filename": "a.jpg", "type": "correction", "original_prediction": "greek", "corrected_label": "islamic"}',
    '{"filename": "cut off',
    "",
    "[1, 2]",
]


def write(path, lines):
    path.mkdir(exist_ok=True)
    (path / f"{len(list(path.iterdir()))}.json").write_text("\n".join(lines) + "\n")


def test_only_unreadable_lines_are_dropped(spark, frame, tmp_path):
    write(tmp_path / "log", LINES)
    log = read_json_lines(spark, f"file://{tmp_path}/log", schemas.FEEDBACK)
    assert log.count() == 4
    rows = sorted((r.predicted, r.actual, r.confidence) for r in split_log(log).collect() if r.confidence is not None)
    assert rows == [("greek", "greek", 0.5), ("greek", "roman", 0.91)]
    dataset = frame("id long, image_path string", (7, "raw/a.jpg"))
    assert sorted(r.human_label for r in feedback_rows(log, dataset).collect()) == ["greek", "islamic", "roman"]


def test_stream_stores_each_answer_once(spark, frame, tmp_path):
    dataset = frame("id long, image_path string", (7, "raw/a.jpg"))
    paths = (f"file://{tmp_path}/log", dataset, f"file://{tmp_path}/out", f"file://{tmp_path}/state")
    for lines in (LINES[:3], LINES, LINES[1:3]):  # delivered again and again
        write(tmp_path / "log", lines)
        sync_feedback(spark, *paths).awaitTermination()
    stored = spark.read.parquet(f"file://{tmp_path}/out").collect()
    assert sorted(r.human_label for r in stored) == ["greek", "islamic", "roman"]


def test_batches_mark_rows_and_keep_state(spark, frame, tmp_path):
    """Three files, one a batch: the second repeats the first, the third holds an entry older than all."""
    dataset = frame("id long, image_path string, is_verified int, needs_review int", (7, "raw/a.jpg", 0, 1), (8, "raw/b.jpg", 0, 1), (9, "raw/c.jpg", 0, 1))
    late = '{"timestamp": -5, "filename": "b.jpg", "label": "roman", "confidence": 0.4}'
    for lines in (LINES[:2], LINES[:2] + LINES[:1], [late]):
        write(tmp_path / "log", lines)
    out, marks = f"file://{tmp_path}/out", f"file://{tmp_path}/marks"
    query = sync_feedback(spark, f"file://{tmp_path}/log", dataset, out, f"file://{tmp_path}/state", marks=marks, files_per_batch=1)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    assert any(s["operatorName"] == "dedupeWithinWatermark" for p in query.recentProgress for s in p["stateOperators"])
    stored = spark.read.parquet(out).collect()
    assert sorted((r.ml_dataset_id, r.human_label) for r in stored) == [(7, "greek"), (7, "roman"), (8, "roman")]
    got = {r.id: (r.is_verified, r.needs_review) for r in verified_dataset(dataset, marks).collect()}
    assert got == {7: (1, 0), 8: (1, 0), 9: (0, 1)}
