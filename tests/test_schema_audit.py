import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql.types import StructType

from tallyfold.operators.schema_audit import audit_schema, file_verdicts, schema_differences


def varint(n):
    n, out = n << 1, b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def avro_file(fields, sized=False):
    """Header of an Avro container file followed by its sync marker and no blocks."""
    meta = {b"avro.codec": b"null", b"avro.schema": json.dumps({"type": "record", "name": "r", "fields": fields}).encode()}
    body = b"".join(varint(len(k)) + k + varint(len(v)) + v for k, v in meta.items())
    count = bytes([3]) + varint(len(body)) if sized else varint(len(meta))
    return b"Obj\x01" + count + body + b"\x00" + b"s" * 16


def names(audit):
    return {(r.path.rsplit("/", 1)[1], r.field): r.verdict for r in audit.collect()}


def test_parquet(spark, tmp_path):
    pq.write_table(pa.table({"id": pa.array([1], pa.int64()), "name": ["x"], "more": [1.0]}), tmp_path / "a.parquet")
    pq.write_table(pa.table({"id": ["1"]}), tmp_path / "b.parquet")
    (tmp_path / "c.parquet").write_bytes(b"not parquet")
    (tmp_path / "d.txt").write_text("ignored")
    audit = audit_schema(spark, str(tmp_path), {"id": "INT", "name": "string"})
    assert names(audit) == {("a.parquet", "id"): "ok", ("a.parquet", "name"): "ok", ("a.parquet", "more"): "extra",
                            ("b.parquet", "id"): "mismatch", ("b.parquet", "name"): "missing", ("c.parquet", None): "unreadable"}
    assert {r.path.rsplit("/", 1)[1]: r.valid for r in file_verdicts(audit).collect()} == {
        "a.parquet": True, "b.parquet": False, "c.parquet": False}


def test_avro(spark, tmp_path):
    (tmp_path / "ok.avro").write_bytes(avro_file([{"name": "id", "type": "long"}, {"name": "u", "type": ["null", "string"]}]))
    (tmp_path / "sized.avro").write_bytes(avro_file([{"name": "id", "type": "long"}], sized=True))
    (tmp_path / "int.avro").write_bytes(avro_file([{"name": "id", "type": "int"}]))
    (tmp_path / "bad.avro").write_bytes(b"Obj\x02")
    audit = audit_schema(spark, str(tmp_path), {"id": "long", "u": '["null", "string"]'}, "avro")
    got = names(audit)
    assert got[("ok.avro", "id")] == got[("ok.avro", "u")] == got[("sized.avro", "id")] == "ok"
    assert got[("int.avro", "id")] == "mismatch" and got[("int.avro", "u")] == "missing"
    assert got[("bad.avro", None)] == "unreadable"


def test_unknown_format(spark, tmp_path):
    with pytest.raises(ValueError):
        audit_schema(spark, str(tmp_path), {}, "csv")


def test_table_schemas(spark):
    got = schema_differences(spark, StructType.fromDDL("a int, b string, d int"), StructType.fromDDL("a int, b double, c int"))
    assert {r.field: r.verdict for r in got.collect()} == {"a": "ok", "b": "mismatch", "c": "missing", "d": "extra"}
