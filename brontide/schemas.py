"""Fixed schemas; reads and writes fail where a table differs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _schema(text: str) -> T.StructType:
    kinds = {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "ntz": T.TimestampNTZType(), "timestamp": T.TimestampType(), "date": T.DateType(), "strings": T.ArrayType(T.StringType())}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in (x.split(":") for x in text.split())])


BRONZE_FORECAST = _schema(
    "request_id:string source_id:string request_params_json:string place_id:string base_date:string base_time:string nx:int ny:int category:string fcst_date:string "
    "fcst_time:string fcst_value:string raw_object_key:string payload_hash:string http_status:int result_code:string result_msg:string total_count:int item_count:int "
    "collected_at:ntz load_date:string dag_run_id:string page_no:int"
)
BRONZE_OBSERVATION = _schema(
    "idempotency_key:string request_id:string source_id:string dag_run_id:string manifest_key:string observed_slot:string observed_at:ntz base_date:string base_time:string "
    "grid_id:string nx:int ny:int category:string observed_value:double unit:string quality_status:string raw_object_key:string payload_sha256:string source_revision:string "
    "http_status:int collected_at:ntz"
)
RUN_MANIFEST = _schema("source_id:string dag_id:string dag_run_id:string status:string is_publishable:boolean event_at:ntz expected_rows:int actual_rows:int expected_raw_objects:int actual_raw_objects:int failure_reason:string")
RAW_MANIFEST = _schema("run_id:string dataset:string load_date:string completed_at:string status:string object_keys:strings expected_count:int actual_count:int")
COVERAGE_GRID = _schema("grid_id:string nx:int ny:int coverage_scope:string")
PLACE_GRID = _schema("place_id:string place_name:string alias_names:string gu:string admin_dong:string latitude:double longitude:double nx:int ny:int mapping_method:string grid_distance_m:double source_admin_code:string")
VINTAGE = _schema("product_family:string grid_id:string nx:int ny:int variable:string value_kind:string value_double:double value_bool:boolean value_text:string unit:string issued_at:timestamp valid_at:timestamp source_id:string source_revision:string")
TRUTH = _schema("grid_id:string nx:int ny:int variable:string value_kind:string value_double:double value_bool:boolean value_text:string unit:string observed_at:timestamp truth_source:string truth_revision:string truth_as_of:timestamp collected_at:timestamp quality:string")
ADMIN_MASTER = _schema("revision_date:string unit_code:string city_name:string region_name:string unit_name:string created_on:string removed_on:string collected_at:ntz")


def require_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df in the schema's column order; raises where names or types differ."""
    have, want = {f.name: f.dataType for f in df.schema}, {f.name: f.dataType for f in schema}
    wrong = sorted(set(have) ^ set(want)) or [n for n in want if have[n] != want[n]]
    if wrong:
        raise ValueError(f"schema differs in {', '.join(wrong)}")
    return df.select(*want)
