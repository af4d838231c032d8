"""Landing tables derived from the sample order tables, by SQL both engines run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from cratewise import schemas

AS_OF = dt.datetime(2001, 8, 10)

# Layout of the sample tables that are read; named here so that no file is opened to infer it.
SAMPLE_SCHEMAS = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
    "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "pages": "page_id BIGINT, url STRING, html STRING",
}

LANDING_SQL = {
    "saved_tracks": """
select concat('t',cast(o_orderkey as string)) track_id,
 case when o_orderkey%211=0 then cast(null as string) else concat(cast(cast(o_orderdate as date) as string),'T',lpad(cast(o_orderkey%24 as string),2,'0'),':00:00Z') end added_at,
 o_orderpriority track_name,
 case when o_orderkey%17=0 then cast(null as string) when o_orderkey%29=0 then '  ' else concat(' us',lpad(cast(o_orderkey%6007 as string),6,'0'),' ') end isrc,
 concat('al',cast(o_custkey%97 as string)) album_id, concat('Album ',cast(o_custkey%97 as string)) album_name,
 cast(cast(o_orderdate as date) as string) album_release_date,
 cast(10+o_orderkey%7 as int) album_total_tracks, cast(1+o_orderkey%12 as int) track_number, cast(1 as int) disc_number,
 cast(case when o_orderkey%23=0 then null else 180000+(o_orderkey%40)*1000 end as int) duration_ms,
 o_orderstatus='F' explicit, cast(case when o_orderkey%13=0 then null else o_orderkey%101 end as int) popularity,
 o_orderkey%19=0 is_local, concat('a',cast(o_custkey as string)) primary_artist_id, concat(' Customer ',cast(o_custkey as string)) primary_artist_name,
 concat('u/',cast(o_orderkey as string)) spotify_track_url, case when o_orderkey%5=0 then cast(null as string) else '2001-08-02T00:00:00+00:00' end ingest_run_at from orders
""",
    "track_artists": """
select concat('t',cast(l_orderkey as string)) track_id, concat('a',cast(min(l_suppkey) as string)) artist_id, concat('Artist ',cast(min(l_suppkey) as string)) artist_name, cast(l_linenumber as int) artist_order, '2001-08-02T00:00:00+00:00' ingest_run_at from lineitem group by l_orderkey,l_linenumber
""",
    "isrc_candidates": """
select concat('t',cast(l_orderkey as string)) track_id, concat('us',lpad(cast(l_orderkey%6007 as string),6,'0')) isrc, concat('r',cast(min(l_partkey) as string)) recording_mbid, cast(l_linenumber as int) match_rank, concat(cast(cast(max(l_shipdate) as date) as string),'T00:00:00+00:00') matched_at, '{}' isrc_response_json from lineitem where l_orderkey%3<>0 group by l_orderkey,l_linenumber
""",
    "recording_payloads": """
select concat('r',cast(p_partkey as string)) recording_mbid, concat('{"title":"',p_name,'","length":"',cast(180000+(p_partkey%40)*1000 as string),'","disambiguation":"v',cast(v as string),
'","artist-credit":[{"artist":{"id":"m',cast(p_partkey%97 as string),'","name":"Zed ',cast(p_partkey%97 as string),'","sort-name":"Z","type":"Person","country":"US"}},{"artist":{"id":"m',cast(p_partkey%89 as string),'","name":"abe ',cast(p_partkey%89 as string),'","sort-name":"A","type":"Group"}}],',
'"release-list":[{"id":"l',cast(p_partkey%500 as string),'","title":"',p_type,'","date":"',case when p_partkey%4=0 then '2001' else concat('20',lpad(cast(p_partkey%20 as string),2,'0'),'-05-06') end,'","country":"GB","status":"Official","release-group":{"id":"g1","title":"G","primary-type":"',case when p_partkey%2=0 then 'Album' else 'Single' end,'","secondary-type-list":["Live"]}},{"id":"k',cast(p_partkey as string),'","title":"B","release-group":{"id":"g2","type":"Single"}}],',
'"tag-list":[{"name":"',lower(p_brand),'","count":"',cast(p_size%5 as string),'"},{"name":"Rock","count":"2"},{"name":" ","count":"9"},{"name":"jazz","count":"x"}],',
'"relation-list":[{"target-type":"work","relation":[{"type":"performance","work":{"id":"w',cast(p_partkey%300 as string),'","title":"W"}}]},{"target-type":"recording","relation":[{"type":"',case when p_partkey%3=0 then 'cover of' else 'covers' end,'","recording":{"id":"r',cast((p_partkey+1)%200 as string),'","title":"R"}}]},{"target-type":"artist","relation":[{"type":"instrument","attributes":["piano"]},{"type":"vocal"}]}],',
'"artist-relation-list":[{"type":"instrument","attribute-list":["<b>Bass</b> Guitar","organ [pipe]",{"attribute":"harp"}]}]}') payload_json,
 concat('2001-08-0',cast(v as string),'T00:00:00+00:00') last_seen_at from (select part.*, 1 as v from part union all select part.*, 2 as v from part where p_partkey%2=0) s
""",
    "work_payloads": """
select concat('w',cast(p_partkey as string)) work_mbid, concat('{"title":"Work ',cast(p_partkey as string),'","type":"Song","language":"eng","relation-list":[{"target-type":"artist","relation":[{"type":"Composer","artist":{"id":"m',cast(p_partkey%31 as string),'","name":"Writer ',cast(p_partkey%31 as string),'"},"attribute-list":["additional"]},{"type":"lyricist","artist":{"id":"m',cast(p_partkey%37 as string),'","name":"writer ',cast(p_partkey%37 as string),'"}},{"type":"publisher","artist":{"id":"m0","name":"P"}}]}]}') payload_json, '2001-08-03T00:00:00+00:00' last_seen_at from part where p_partkey<300 and p_partkey%7<>0
""",
    "isrc_failures": """
select concat('us',lpad(cast(c_custkey*3 as string),6,'0')) isrc, case when c_custkey%2=0 then '404' else '503' end error_status_code, case when c_custkey%11=0 then cast(null as string) else concat('HTTP Error ',cast(c_custkey as string)) end error_message, case when c_custkey%10=0 then 'bad' else concat('2001-0',case when c_custkey%3=0 then '8' else '7' end,'-',lpad(cast(1+c_custkey%28 as string),2,'0'),'T00:00:00+00:00') end last_failed_at, cast(case when c_custkey%9=0 then null else c_custkey%13 end as int) error_404_count from customer
""",
}


# The sample table each landing table is made from.
MADE_FROM = {
    "saved_tracks": "orders",
    "track_artists": "lineitem",
    "isrc_candidates": "lineitem",
    "recording_payloads": "part",
    "work_payloads": "part",
    "isrc_failures": "customer",
}

# Sample rows that one task turns into documents, for the tables whose rows are much larger than
# those they are made from: about 50 MB of text, however the sample's file is cut.
DOCUMENT_ROWS = {"recording_payloads": 20_000}


def sample(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SAMPLE_SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


# Folders with landing tables that were stored, by the sample folder they were made from.
_STORED: dict[str, str] = {}


def store_landing(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Store the landing tables once; from now on they are read instead of derived."""
    for name, df in landing(spark, sf_dir).all().items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
    _STORED[sf_dir] = folder


class Landing(dict):
    """Landing tables by name over one set of sample tables, each planned when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._spark = spark
        self._sf_dir = sf_dir

    def __missing__(self, name: str) -> DataFrame:
        if self._sf_dir in _STORED:
            path = f"{_STORED[self._sf_dir]}/{name}"
            self[name] = self._spark.read.schema(schemas.LANDING[name]).parquet(path)
            return self[name]
        table = MADE_FROM[name]
        rows = sample(self._spark, self._sf_dir, table)
        if name in DOCUMENT_ROWS and (tasks := rows.count() // DOCUMENT_ROWS[name]):
            rows = rows.repartition(tasks + 1)
        rows.createOrReplaceTempView(table)
        self[name] = self._spark.sql(LANDING_SQL[name])
        return self[name]

    def all(self) -> dict[str, DataFrame]:
        return {name: self[name] for name in LANDING_SQL}


def landing(spark: SparkSession, sf_dir: str) -> Landing:
    return Landing(spark, sf_dir)
