import base64
import hashlib

from pyspark.sql import functions as F

from devmetrics.llm import secret_scan
from tests.llm.conftest import prose


def findings(spark, start, n):
    rows = []
    for i in range(start, start + n):
        code = hashlib.sha1(str(i).encode()).hexdigest()
        words = prose(i, 40)
        kind = i % 4
        if kind == 0:
            words[20:20] = ["token", "=", f'"{code}"']
        elif kind == 1:
            words[20:20] = ["see", "".join(prose(i + 999, 3))]
        elif kind == 2:
            words[20:20] = ["number", str(int(code[:14], 16)).rjust(17, "4")]
        rows.append((i, " ".join(words), f"src{i % 3}", code))
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, candidate string")


def test_held_out_accuracy(spark):
    train, test = findings(spark, 0, 400), findings(spark, 1000, 200)
    labelled = secret_scan.cue_labels(secret_scan.candidates(train))
    out = secret_scan.scan(test, labelled)
    truth = out.join(test.select("doc_id", F.col("candidate").alias("code")), "doc_id")
    right = truth.filter((F.col("candidate") == F.col("code")) == F.col("is_secret")).count()
    assert right >= 0.98 * truth.count() and truth.filter("is_secret").count() == 50


def test_odd_rows(spark, odd, nothing):
    assert secret_scan.scan(nothing).count() == 0
    out = secret_scan.scan(odd)
    assert out.filter("is_secret").count() == 0
    twice = spark.createDataFrame([(1, "a1b2c3d4e5f6a7b8c9 a1b2c3d4e5f6a7b8c9", None)], "doc_id bigint, text string, source string")
    assert [r["position"] for r in secret_scan.scan(twice).orderBy("position").collect()] == [0, 1]


def test_every_run_of_a_word_is_a_candidate(spark):
    a, b, c = "AKIA0123456789ABCD", "a1b2c3d4e5f6a7b8c9d0", "ZXCVBNMASDFGHJKLQW"
    text = f'see {{"id":"{a}","secret":"{b}","short":"x1","again":"{b}"}} {c}'
    docs = spark.createDataFrame([(1, text, None)], "doc_id bigint, text string, source string")
    got = sorted((r["position"], r["run"], r["candidate"]) for r in secret_scan.scan(docs).collect())
    assert got == [(1, 0, a), (1, 1, b), (1, 2, b), (2, 0, c)]


def test_written_forms_without_labelled_findings(spark):
    """Secrets in five forms, labelled by construction; the bare ones have no cue to be learned from."""
    forms = ['api_key={}', "password: {}", '{{"user":"u","secret":"{}","n":1}}', "-----BEGIN PRIVATE KEY----- {}", "{}"]
    rows, truth = [], {}
    for i in range(500):
        words, code = prose(i, 40), hashlib.sha256(str(i).encode())
        bare = base64.b64encode(code.digest()).decode() if i % 2 else code.hexdigest()[:40]
        decoy = ["".join(prose(i + 999, 5)), str(int(code.hexdigest()[:14], 16)).rjust(17, "4")][i // 5 % 2]
        words[20:20], words[10:10] = forms[i % 5].format(bare).split(), [decoy]
        truth[i, bare], truth[i, decoy] = True, False
        rows.append((i, " ".join(words), f"src{i % 3}"))
    out = secret_scan.scan(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    got = {(r["doc_id"], r["candidate"]): r["is_secret"] for r in out}
    assert truth.keys() <= got.keys()
    for form in range(5):
        right = [got[k] == v for k, v in truth.items() if k[0] % 5 == form]
        assert sum(right) >= 0.98 * len(right), forms[form]


def test_clear_labels_only(spark):
    code = "9f86d081884c7d659a2f"
    texts = [f"token = '{code}'", f"token='{code}'", f"my_token: {code}", f"see {code}", f"the key {code}", "averylongplainword"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").selectExpr("*", "'s' AS source")
    found = secret_scan.cue_labels(secret_scan.candidates(docs)).orderBy("doc_id").collect()
    assert [r["label"] for r in found] == [1.0, 1.0, 1.0, None, None, 0.0]
