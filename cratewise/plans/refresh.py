"""One run: take in pages, export the queue, load lookup results, build and check tables.

Fetching from the services happens outside. A run reads what they returned: saved-track
pages, and after the queue file was worked off, the lookup answers. Landing tables live
under ``<root>/landing``, files under ``<root>/exchange``, finished tables under
``<root>/finished``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cratewise import schemas
from cratewise.functions.documents import STRICT
from cratewise.functions.text import tidy_code
from cratewise.operators import quality, state
from cratewise.plans import intake, queue
from cratewise.plans.checks import not_null_checks, unique_checks
from cratewise.plans.models import PUBLISHED, Models
from cratewise.plans.update import KEPT, Touched, Update
from cratewise.session import copied, prepare, stored
from cratewise.sources import documents, files
from cratewise.sources.folders import Folder
from cratewise.sources.tables import Change, KeyedTables, Tables, empty, fill_counter

PAGES = "page_no BIGINT, body STRING"
ANSWERS = {
    "codes": "isrc STRING, body STRING, error STRING",
    "recordings": "recording_mbid STRING, body STRING, error STRING",
    "works": "work_mbid STRING, body STRING, error STRING",
}
# Columns of the result files that hold JSON documents.
DOCUMENTS = ["payload_json", "isrc_response_json"]
# What the landing tables are keyed by, for remembering what changed.
KEYS = {"tracks": "track_id", "recordings": "recording_mbid", "works": "work_mbid"}


class Refresh:
    def __init__(self, spark: SparkSession, root: str, as_of: dt.datetime, buckets: int = 64):
        self.spark = prepare(spark)
        self.root = root.rstrip("/")
        self.as_of = as_of
        self.stamp = as_of.replace(tzinfo=dt.timezone.utc).isoformat()
        self.landing = KeyedTables(spark, f"{self.root}/landing", buckets)
        self.finished = Tables(spark, f"{self.root}/finished")
        self.builds = f"{self.root}/builds"
        self.changes = f"{self.root}/changes"

    def tables(self) -> dict[str, DataFrame]:
        """Current landing tables; absent ones are empty."""
        rows = {name: self.landing.read(name, ddl) for name, ddl in schemas.LANDING.items()}
        rows["isrc_failures"] = fill_counter(rows["isrc_failures"], "error_404_count")
        return rows

    def high_water_mark(self) -> dt.datetime | None:
        """When the newest stored track was added; None before the first run."""
        newest = state.high_water_mark(self.tables()["saved_tracks"]).first()[0]
        return dt.datetime.fromisoformat(newest) if newest else None

    def take_in(
        self, pages_path: str, max_tracks: int | None = None, complete: bool = True
    ) -> None:
        """Merge the unread items of the saved-track pages (JSON lines) into the landing tables."""
        self.take_pages(self.spark.read.schema(PAGES).json(pages_path, **STRICT), max_tracks, complete)

    def take_pages(
        self, pages: DataFrame, max_tracks: int | None = None, complete: bool = True
    ) -> None:
        """Merge the unread items of pages, newest first, into the landing tables.

        ``max_tracks`` caps the new tracks of this run; the next run goes on from there.
        ``complete`` says that the pages go down to the oldest track.
        """
        gaps = intake.read_gaps(self.landing.read("intake_gaps", intake.GAPS))
        gaps = gaps or [intake.Gap(self.high_water_mark(), None)]
        # Everything below reads these items; the pages are parsed once, and of what earlier
        # runs have read nothing is stored again.
        items = stored(intake.open_items(documents.page_items(pages), gaps))
        reached = Change("track_id", schemas.SAVED_TRACKS, items.select("track_id"), lambda x: x)
        saved = self.landing.read(
            "saved_tracks", schemas.SAVED_TRACKS, self.landing.touched(reached)
        )
        # Tracks stay where they lie: only keys, dates and places meet the saved tracks.
        wanted = stored(intake.wanted_items(items.drop("track"), gaps, saved))
        beyond, left = intake.take(wanted, gaps, max_tracks, complete)
        taken = items.where(~beyond)
        tracks = documents.flatten_tracks(taken, self.stamp)
        artists = documents.flatten_track_artists(taken, self.stamp)
        keys = stored(taken.select("track_id").distinct())
        self._note(tracks=keys)
        rest = self.spark.createDataFrame(intake.gap_rows(left), intake.GAPS)
        self.landing.update(
            saved_tracks=Change(
                "track_id", schemas.SAVED_TRACKS, keys,
                lambda now: state.replace_children(now, keys, tracks, "track_id"),
            ),
            track_artists=Change(
                "track_id", schemas.TRACK_ARTISTS, keys,
                lambda now: state.replace_children(now, keys, artists, "track_id"),
            ),
            # A few rows in one bucket.
            intake_gaps=Change("above", intake.GAPS, rest, lambda _: rest, lambda _: F.lit("gaps")),
        )

    def export_queue(self, max_codes: int | None = None) -> str:
        """Write the queue file, of all codes or of the first ones, and return its path."""
        models = Models(self.tables(), self.as_of)
        path = f"{self.root}/exchange/enrichment_queue.csv"
        files.export_queue(queue.enrichment_queue(models.due, max_codes), path)
        return path

    def collect_results(self, answers_path: str, queue_path: str) -> None:
        """Turn lookup answers (JSON lines per kind) into result files and a summary.

        The files are CSV, as published, and Parquet for the next step.
        """
        queued = files.read_csv(self.spark, queue_path, schemas.QUEUE_FILE)
        if queued is None:
            raise FileNotFoundError(f"no queue file at {queue_path}; export it first")
        queued = stored(queued)
        answers = {
            kind: self.spark.read.schema(ddl).json(f"{answers_path}/{kind}", **STRICT)
            for kind, ddl in ANSWERS.items()
        }
        found = documents.results(
            answers["codes"], answers["recordings"], answers["works"], queued, self.stamp
        )
        written = {}
        for name, df in found.items():
            path = self._result_path(name)
            folded = {x: files.one_line(F.col(x)) for x in DOCUMENTS if x in df.columns}
            df.withColumns(folded).write.mode("overwrite").parquet(f"{path}.parquet")
            written[name] = self.spark.read.schema(df.schema).parquet(f"{path}.parquet")
            files.write_csv(written[name], f"{path}.csv")
        codes = documents.queued_tracks(queued).select("isrc")
        summary = files.run_summary(written, self.as_of, codes)
        summary.write.mode("overwrite").json(f"{self.root}/exchange/summary.json")

    def load_results(self) -> None:
        """Merge the result files that are there into the landing tables.

        The Parquet files of ``collect_results`` are taken, CSV files where there are none.
        """
        new = {name: self._result(name, ddl) for name, ddl in schemas.RESULT_FILES.items()}
        changes = {}

        def merge(name: str, key: str, rows: DataFrame) -> None:
            changes[name] = Change(
                key, schemas.LANDING[name], rows.select(key),
                lambda now: state.upsert_by_key(now, rows, [key]),
            )

        if (candidates := new["isrc_candidates"]) is not None:
            rows = candidates.withColumns(
                {"isrc": tidy_code(F.col("isrc")), "match_rank": F.col("match_rank").cast("int")}
            )
            self._note(tracks=rows)
            merge("isrc_candidates", "track_id", rows)
        for name, key in (("recording_payloads", "recording_mbid"), ("work_payloads", "work_mbid")):
            if (payloads := new[name]) is not None:
                self._note(**{name.replace("_payloads", "s"): payloads})
                merge(name, key, payloads)
        if (failures := new["isrc_failures"]) is not None:
            changes["isrc_failures"] = Change(
                "isrc", schemas.ISRC_FAILURES, failures.select("isrc"),
                lambda now: state.merge_failures(fill_counter(now, "error_404_count"), failures),
                tidy_code,
            )
        if changes:
            self.landing.update(**changes)

    def build(self) -> Models:
        """Store all finished tables and register them as views under their names."""
        number = self._newest_build() + 1
        return self._publish(Models(self.tables(), self.as_of, self._keep(number)), number)

    def refresh(self) -> Models:
        """The same from the last build: only keys touched since then are staged and joined.

        Without a build, or after the tracks were cleared, everything is built.
        """
        last = self._newest_build()
        if not last or Folder(self.spark, f"{self.changes}/all").exists():
            return self.build()

        def built(name: str) -> DataFrame:
            return self.spark.read.parquet(f"{self.builds}/{last}/{name}")

        touched = Touched(**{kind: self._touched(kind) for kind in KEYS})
        update = Update(built, self.tables(), touched, self.as_of, self._keep(last + 1))
        return self._publish(update.models, last + 1)

    def _publish(self, models: Models, number: int) -> Models:
        for name in KEPT:
            getattr(models, name)
        rows = {name: models.published(name) for name in PUBLISHED}
        self.finished.replace(**rows)
        for name, df in rows.items():
            self.finished.read(name, df.schema).createOrReplaceTempView(name)
        # Only now the build is one to go on from, and the changes are done with.
        Folder(self.spark, f"{self.builds}/{number}/_done").create()
        Folder(self.spark, self.changes).delete()
        if number > 2:
            Folder(self.spark, f"{self.builds}/{number - 2}").delete()
        return models

    def _keep(self, number: int):
        """Store a table of a build and read it back; a build that died is written over."""

        def keep(name: str, df: DataFrame) -> DataFrame:
            return copied(df, f"{self.builds}/{number}/{name}", "overwrite")

        return keep

    def _newest_build(self) -> int:
        """The last build that was finished; 0 before the first."""
        numbers = [int(name) for name in Folder(self.spark, self.builds).names()]
        done = [n for n in numbers if Folder(self.spark, f"{self.builds}/{n}/_done").exists()]
        return max(done, default=0)

    def _note(self, **rows: DataFrame) -> None:
        """Remember keys of a batch, before it is merged: a run that dies forgets none."""
        for kind, df in rows.items():
            keys = df.select(KEYS[kind]).distinct()
            keys.write.mode("append").parquet(f"{self.changes}/{kind}")

    def _touched(self, kind: str) -> DataFrame:
        schema = f"{KEYS[kind]} STRING"
        if not Folder(self.spark, f"{self.changes}/{kind}").exists():
            return empty(self.spark, schema)
        return self.spark.read.schema(schema).parquet(f"{self.changes}/{kind}")

    def check(self) -> dict[str, DataFrame]:
        """Data-quality reports over the registered tables and the landing tables."""
        stored = {name: self.spark.table(name) for name in PUBLISHED}
        now = self.tables()
        fresh = [
            quality.freshness(now[name], name, "ingest_run_at", self.as_of)
            for name in ("saved_tracks", "track_artists")
        ]
        return {
            "not_null": not_null_checks(stored),
            "unique": unique_checks(stored),
            "freshness": fresh[0].unionByName(fresh[1]),
        }

    def clear_saved_tracks(self) -> bool:
        """Empty the saved tracks; False when there are none stored."""
        Folder(self.spark, f"{self.changes}/all").create()
        return self.landing.clear("saved_tracks", schemas.SAVED_TRACKS)

    def _result(self, name: str, ddl: str) -> DataFrame | None:
        path = self._result_path(name)
        if Folder(self.spark, f"{path}.parquet").exists():
            return self.spark.read.parquet(f"{path}.parquet")
        rows = files.read_csv(self.spark, f"{path}.csv", ddl)
        # A CSV file may be read by one task; what follows reads a copy.
        return None if rows is None else stored(rows)

    def _result_path(self, name: str) -> str:
        return f"{self.root}/exchange/results/{name}"
