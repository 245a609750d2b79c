import re

from pyspark.sql import functions as F

from devmetrics.llm import pii


def rewritten(spark, *texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return [r["text"] for r in pii.pseudonymised(docs, **options).orderBy("doc_id").collect()]


def luhn(number):
    digits = [int(c) for c in number if c.isdigit()][::-1]
    return (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10


def test_type_and_format_are_kept(spark):
    mail, phone, card, bad, ssn, iban, ip = rewritten(
        spark, "to jo.doe7@mail.com!", "+1 (017) 555-7713", "4111 1111 1111 1111", "9807915762804490",
        "123-45-6789", "DE89 3704 0044 0532 0130 00", "at 152.143.123.131###",
    )
    assert re.fullmatch(r"to [a-z]{2}\.[a-z]{3}\d@[a-z]{8}\.example\.com!", mail) and "doe" not in mail
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", phone) and phone != "+1 (017) 555-7713"
    assert re.fullmatch(r"4\d{3}( \d{4}){3}", card) and luhn(card) == 0 and "1111 1111" not in card
    assert re.fullmatch(r"9\d{15}", bad) and luhn(bad) != 0
    assert re.fullmatch(r"9\d\d-\d\d-\d{4}", ssn)
    moved = re.sub(" ", "", iban)
    assert int("".join(str(int(c, 36)) for c in moved[4:] + moved[:4])) % 97 == 1 and len(iban) == 27
    assert re.fullmatch(r"at 2[45]\d(\.\d{1,3}){3}###", ip)


def test_one_entity_one_surrogate(spark):
    a, b, c = rewritten(spark, "x@y.org and X@Y.ORG", "card 4111111111111111 or 4111-1111-1111-1111", "x@y.org z@y.org")
    low, high = a.split(" and ")
    assert low.upper() == high and c.split()[0] == low
    assert c.split()[0].split("@")[1] == c.split()[1].split("@")[1]
    one, two = b.removeprefix("card ").split(" or ")
    assert two.replace("-", "") == one


def test_names_keep_gender_and_script(spark):
    (text,) = rewritten(spark, "Anna Keller met Mr. Keller and Peter Schmidt; Мария Иванова и Господин Иванов")
    m = re.fullmatch(r"(\w+) (\w+) met Mr\. (\w+) and (\w+) (\w+); (\w+) (\w+)а и Господин (\w+)", text)
    assert m[1] in pii.NAMES["female"][1] and m[4] in pii.NAMES["male"][1] and m[6] in pii.NAMES["female_cyrillic"][1]
    assert m[2] == m[3] != m[5] and m[7] == m[8]


def test_surrogates_stay_distinct_when_they_collide(spark):
    """Two-character local parts have 260 surrogates of their form: 300 of them must collide."""
    each = [f"{chr(97 + i % 26)}{i // 26 % 10}@one.com" for i in range(250)]
    each += [f"{chr(97 + i)}@one.com" for i in range(26)]
    known = spark.createDataFrame([("email", e) for e in each], "kind string, value string")
    docs = spark.createDataFrame(list(enumerate(each)), "doc_id bigint, text string")
    from devmetrics.llm.staging import Workspace

    later = pii.attempts(known, Workspace(spark))
    assert later.count() > 0
    out = [r["text"] for r in pii.pseudonymised(docs).collect()]
    assert len(set(out)) == len(each) and not set(out) & set(each)


def test_keys_matter_and_clean_texts_stay(spark, odd, nothing):
    assert rewritten(spark, "x@y.org", key=b"1") != rewritten(spark, "x@y.org", key=b"2")
    clean = ["version 3. 4.0 of 2024-01-01", "An apple. The end", "1.2.3", "Anna said", "12345", None, ""]
    assert rewritten(spark, *clean) == clean
    out = pii.pseudonymised(odd)
    assert out.columns == odd.columns and out.exceptAll(odd).count() == 0 and out.count() == odd.count()
    assert pii.pseudonymised(nothing).count() == 0


def test_mentions_are_counted(spark):
    docs = spark.createDataFrame([(1, "a@b.com, 10.2.3.4 " * 3)], "doc_id bigint, text string")
    assert pii.pseudonymised(docs, mentions="n").select(F.sum("n")).first()[0] == 6


def test_prose_is_no_bank_account(spark):
    prose = ["FY20 PLAN WILL GROW", "FY21 PLAN WILL GROW"]
    real = "BE68 5390 0754 7034"
    *same, mixed, behind = rewritten(spark, *prose, f"pay {real} THIS WEEK", f"FY20 PLAN WILL {real}")
    assert same == prose
    assert mixed.endswith(" THIS WEEK") and mixed.startswith("pay BE") and real not in mixed
    assert behind == f"FY20 PLAN WILL {mixed[4:-10]}"


def test_formats_without_free_values_widen(spark):
    """Surrogates stay valid, and get longer from some attempt on."""
    rows = [("iban", "BE68539007547034", n) for n in (0, 30)] + [("card", "4111111111111111", n) for n in (0, 30)]
    rows += [("ssn", "123456789", 30), ("ip", "1.2.3.4", 30), ("female", "anna", 30), ("phone", "+12025550100", 30)]
    df = spark.createDataFrame(rows, "kind string, value string, attempt int")
    made = [r[0] for r in df.coalesce(1).select(pii.surrogate(F.col("kind"), F.col("value"), F.col("attempt"))).collect()]
    assert len(made[0]) == 16 < len(made[1]) and len(made[2]) == 16 < len(made[3])
    for iban in made[:2]:
        assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    assert luhn(made[2]) == luhn(made[3]) == 0 and len(made[4]) > 9 and made[5].count(".") == 4
    assert made[6] not in [n.lower() for n in pii.NAMES["female"][1].split()] and len(made[7]) > 12
