"""Every registered query against its oracle SQL in DuckDB, and skewed against plain ways."""

import subprocess
import sys
from pathlib import Path

import pytest
from conftest import SF_DIR

import __spark_entry__ as entry
from cratewise.fixtures import landing
from cratewise.oracle import oracle_sql
from cratewise.plans import marts, queue, reports
from cratewise.plans.models import Models
from cratewise.registry import QUERIES
from tools.compare import compare, duck


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_every_query_has_oracle_sql():
    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(entry.queries()) and set(oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, connection, name):
    note, _, _ = compare(spark, connection, name, SF_DIR)
    assert note is None or note.startswith("types"), note


def test_entry(spark):
    assert entry.entry(spark).count() == 10


WITHOUT = """
import sys

class Absent:
    def find_spec(self, name, path=None, target=None):
        if name in ("corpus_pipeline", "cratewise.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)

sys.meta_path.insert(0, Absent())
import __spark_entry__ as entry
assert "top_artists" in entry.queries() and "pipeline" not in entry.queries()
assert set(entry.queries()) == set(entry.oracle_sql())
"""


def test_entry_works_without_the_optional_subpackage():
    root = Path(__file__).resolve().parents[1]
    subprocess.run([sys.executable, "-c", WITHOUT], cwd=root, check=True)


HOT_WAYS = {
    "queue": lambda m, hot: queue.enrichment_queue(m.due, hot_rows=hot),
    "codes": lambda m, hot: queue.ranked_codes(m.due, hot_rows=hot),
    "albums": lambda m, hot: marts.isrc_duplicate_albums(m.tracks, hot_rows=hot),
    "detail": lambda m, hot: reports.isrc_duplicate_detail(m.tracks, hot_rows=hot),
    "lines": lambda m, hot: reports.isrc_duplicate_lines(m.tracks, hot_rows=hot),
    "durations": lambda m, hot: reports.title_duration_duplicates(m.tracks, hot_rows=hot),
}


@pytest.mark.parametrize("name", HOT_WAYS)
def test_hot_groups_give_the_same_rows(spark, sf_dir, as_of, name):
    """A third of the tracks share one code, one artist and one title."""
    raw = landing(spark, sf_dir)
    crowd = "cast(substr(track_id, 2) as bigint) % 3 = 0"
    raw["saved_tracks"] = raw["saved_tracks"].selectExpr(
        "* except (isrc, primary_artist_name, track_name)",
        f"if({crowd}, 'crowd', isrc) as isrc",
        f"if({crowd}, 'Crowd', primary_artist_name) as primary_artist_name",
        f"if({crowd}, 'Song', track_name) as track_name",
    )
    m = Models(raw, as_of)
    hot, plain = HOT_WAYS[name](m, 20), HOT_WAYS[name](m, 1_000_000)
    assert plain.count() > 0
    assert hot.exceptAll(plain).isEmpty() and plain.exceptAll(hot).isEmpty()
