"""Pod documents, labels (B23, B24) and token claims."""

from __future__ import annotations

import base64
import json

from pyspark.sql import functions as F

from corvid.functions.tokens import service_account, token_claims
from corvid.operators.documents import pod_labels, render_pod_json, tokens_per_account
from corvid.operators.placement import DRIVER_LABEL, EXECUTOR_LABEL, affinity_id


def test_executor_document(spark):
    df = spark.createDataFrame([(7, 4 * 2 ** 30, None, 0.5, 1500)],
                               "task_id long, memory long, memory_overhead long, "
                               "memory_overhead_factor double, request_cores long")
    doc = json.loads(render_pod_json(df, "executor").first().pod_json)
    assert doc["apiVersion"] == "v1" and doc["kind"] == "Pod"
    (label, ex_id), = doc["metadata"]["labels"].items()
    assert label == EXECUTOR_LABEL
    c, = doc["spec"]["containers"]
    assert c["name"] == "spark"
    assert c["resources"] == {"limits": {"memory": "2048Mi"}, "requests": {"cpu": "1500m", "memory": "2048Mi"}}
    terms = doc["spec"]["affinity"]["podAffinity"]["preferredDuringSchedulingIgnoredDuringExecution"]
    assert [t["weight"] for t in terms] == [100, 75, 50, 25]
    driver_id = spark.range(1).select(affinity_id("driver", F.lit(7))).first()[0]
    for t in terms:
        expr, = t["podAffinityTerm"]["labelSelector"]["matchExpressions"]
        assert expr["operator"] == "In"
        assert expr["values"] == [driver_id if expr["key"] == DRIVER_LABEL else ex_id]
    assert doc["spec"]["dnsConfig"] == {"options": [{"name": "ndots", "value": "2"}]}


def test_driver_document_and_empty_parts(spark):
    df = spark.createDataFrame([(1,)], "task_id long").withColumn("memory", F.lit(None).cast("long")) \
        .withColumn("request_cores", F.lit(None).cast("long"))
    doc = json.loads(render_pod_json(df, "driver").first().pod_json)
    c, = doc["spec"]["containers"]
    assert c["name"] == "base" and c["resources"] == {}
    assert [e["name"] for e in c["env"]] == ["SPARK_DRIVER_POD_NAME", "SPARK_DRIVER_POD_IP",
                                              "SPARK_DRIVER_AFFINITY_ID"]
    assert doc["spec"]["affinity"] == {}
    assert DRIVER_LABEL in doc["metadata"]["labels"]


def test_own_labels_win(spark):
    df = spark.createDataFrame([(1, {"team": "a"}), (2, None)], "task_id long, labels map<string,string>")
    got = {r.task_id: r.l for r in df.select("task_id", pod_labels("task_id", "executor",
                                                                   F.col("labels")).alias("l")).collect()}
    assert got[1] == {"team": "a"} and list(got[2]) == [EXECUTOR_LABEL]


def _b64(obj) -> str:
    raw = obj if isinstance(obj, bytes) else json.dumps(obj).encode()
    return base64.urlsafe_b64encode(raw).decode().rstrip("=")


def test_token_claims(spark):
    claims = {"sub": "system:serviceaccount:ns:x",
              "kubernetes.io": {"namespace": "ns", "serviceaccount": {"name": "runner", "uid": "u"}}}
    nameless = {"kubernetes.io": {"serviceaccount": {"uid": "u"}}}
    tokens = [f"{_b64({'alg': 'none'})}.{_b64(claims)}.{_b64(b'sig')}",
              f"{_b64({'alg': 'none'})}.{_b64(nameless)}.{_b64(b'sig')}",
              "not-a-token", f"a.{_b64(b'{not json')}.c", None]
    df = spark.createDataFrame([(t,) for t in tokens], "token string")
    rows = df.select(service_account("token").alias("a"),
                     token_claims("token")["kubernetes.io"]["namespace"].alias("ns")).collect()
    assert [r.a for r in rows] == ["runner", "default", None, None, None]
    assert rows[0].ns == "ns"
    counts = {r.account: r.n_tokens for r in tokens_per_account(df).collect()}
    assert counts == {"runner": 1, "default": 1, None: 3}


def test_supplied_parts_pass_through(spark):
    df = spark.createDataFrame(
        [(1, {"disk": "ssd"}, [("dedicated", "Equal", "spark", "NoSchedule")], [("data", "/data")],
          [("JAVA_HOME", "/opt/java")])],
        "task_id long, node_selector map<string,string>, "
        "tolerations array<struct<key:string,operator:string,value:string,effect:string>>, "
        "volume_mounts array<struct<name:string,mountPath:string>>, "
        "environment_variables array<struct<name:string,value:string>>")
    ex = json.loads(render_pod_json(df, "executor").first().pod_json)
    assert ex["spec"]["nodeSelector"] == {"disk": "ssd"}
    assert ex["spec"]["tolerations"][0]["effect"] == "NoSchedule"
    c, = ex["spec"]["containers"]
    assert c["volumeMounts"] == [{"name": "data", "mountPath": "/data"}]
    assert c["env"] == [{"name": "JAVA_HOME", "value": "/opt/java"}]
    assert list(ex["spec"]) == sorted(ex["spec"])
    drv = json.loads(render_pod_json(df, "driver").first().pod_json)
    assert drv["spec"]["containers"][0]["env"] == [{"name": "JAVA_HOME", "value": "/opt/java"}]


def test_supplied_parts_replace_defaults(spark):
    df = spark.createDataFrame(
        [(1, [("main", "img:1")], None), (2, None, None)],
        "task_id long, containers array<struct<name:string,image:string>>, "
        "environment_variables array<struct<name:string,value:string>>")
    docs = {r.task_id: json.loads(r.pod_json) for r in render_pod_json(df, "driver").collect()}
    assert docs[1]["spec"]["containers"] == [{"image": "img:1", "name": "main"}]
    c, = docs[2]["spec"]["containers"]
    assert c["name"] == "base" and [e["name"] for e in c["env"]][0] == "SPARK_DRIVER_POD_NAME"


def test_base64url_against_python(spark):
    from corvid.functions.tokens import base64url_decode, base64url_encode
    raws = [bytes(range(256)) * n + b"\xfb\xff\xfe"[:k] for n in (0, 1, 3) for k in range(4)]
    df = spark.createDataFrame([(r, base64.urlsafe_b64encode(r).decode().rstrip("=")) for r in raws], "raw binary, text string")
    for r in df.select("raw", "text", base64url_encode(F.col("raw")).alias("e"), base64url_decode(F.col("text")).alias("d")).collect():
        assert (r.e, bytes(r.d)) == (r.text, bytes(r.raw))


def test_payload_needs_three_segments(spark):
    from corvid.functions.tokens import token_payload
    texts = ["a.e30.b", ".e30.", "e30", "a.e30", "a.e30.b.c", "a..b", "", None, "a.e*0.b"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1).select(token_payload("t")).collect()]
    assert got == ["{}", "{}", None, None, None, "", None, None, None]


def test_tokens_are_made_in_many_tasks(spark, tmp_path):
    """A table of one file and row group is dealt out before its tokens are made."""
    from corvid.plans.fixtures import fx_token
    rows = [(i if i % 50 else None, i % 25, "BUILDING") for i in range(1000)]
    (spark.createDataFrame(rows, "c_custkey long, c_nationkey int, c_mktsegment string").coalesce(1)
     .write.parquet(str(tmp_path / "customer.parquet")))
    tokens = fx_token(spark, str(tmp_path))
    used = tokens.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(used) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sum(r["count"] for r in used) == 1000
