import subprocess
import sys
import time
from pathlib import Path

from folia.session import kept, new_path, temporary_tables, written

ROOT = Path(__file__).resolve().parents[1]
RUN = """
import sys
from folia.session import build_session, durable, written
spark = build_session("own", "local[2]", **{"spark.checkpoint.dir": sys.argv[1], "spark.ui.enabled": "false"})
spark.sparkContext.setLogLevel("OFF")
assert written(spark.range(9), "numbers").count() == 9
assert durable(spark.range(5)).count() == 5
"""


def files(path):
    return [p for p in Path(path).rglob("*") if p.is_file()]


def test_tables_go_with_their_block(spark):
    with temporary_tables(spark):
        outer = written(spark.range(3), "outer")
        with temporary_tables(spark):
            path = new_path(spark, "inner")
            spark.range(4).write.parquet(path)
            assert files(path)
        assert not Path(path).exists()
        assert outer.count() == 3
        place = Path(outer.inputFiles()[0].removeprefix("file://")).parent
    assert not place.exists()


def test_what_is_kept_outlives_its_helpers(spark):
    helpers = []

    def make():
        helpers.append(written(spark.range(6), "helper"))
        return helpers[0].filter("id > 2")

    result = kept(spark, make, "result")
    assert result.count() == 3
    assert not files(new_path(spark, "x").rsplit("/", 1)[0] + "/none")
    assert not [p for p in Path(new_path(spark, "x")).parent.iterdir() if p.name.startswith("helper")]


def test_the_shared_folder_is_empty_after_a_run(scratch):
    subprocess.run([sys.executable, "-c", RUN, scratch], cwd=ROOT, check=True, timeout=120)
    # The JVM ends after the script.
    for _ in range(60):
        if not files(scratch):
            break
        time.sleep(0.5)
    assert files(scratch) == []
