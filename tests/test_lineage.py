from urllib.parse import urlparse

from conftest import rows_of
from tradewind.operators.lineage import CHECKPOINT_SETTING, checkpoint_folder, written


def test_written_frames_go_to_the_folder_the_session_names(spark):
    configured = urlparse(spark.conf.get(CHECKPOINT_SETTING)).path
    assert urlparse(checkpoint_folder(spark)).path.startswith(configured)


def test_written_frame_keeps_rows_and_drops_its_history(spark):
    frame = spark.range(20).selectExpr("id % 3 AS part", "id").groupBy("part").count()
    again = written(frame)
    assert rows_of(again) == rows_of(frame)
    text = again._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in text and "Exchange" not in text
