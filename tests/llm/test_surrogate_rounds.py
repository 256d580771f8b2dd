"""Entities whose surrogates could not pass the collision checks."""

import re

from pyspark.sql import functions as F

from caselake.llm import surrogates


def cleaned(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.clean for r in surrogates.replace_entities(docs, ["doc_id"]).orderBy("row.doc_id").collect()]


def test_what_never_passed(spark):
    left = ["Password: ________", "token: -------- and x", "API token:\n========="]
    got = cleaned(spark, [*left, "___@a.com wrote", "Mr. Արամ Սարյան came", "Mr. Սարյան left", "Mr. 𝐀𝐝𝐚 left"])
    assert got[:3] == left and re.fullmatch(r"___\w*@[a-z]\.com wrote", got[3]) and got[3] != "___@a.com wrote"
    both, one = re.fullmatch(r"Mr\. ([Ա-Ֆ][ա-ֆ]+ [Ա-Ֆ][ա-ֆ]+) came", got[4])[1], re.fullmatch(r"Mr\. ([Ա-Ֆ][ա-ֆ]+) left", got[5])[1]
    assert both.split()[1] == one and not {"Արամ", "Սարյան"} & set(both.split())
    assert re.fullmatch(r"Mr\. [A-Z][a-z]+ left", got[6])


def test_full_spaces(spark):
    canons = {"surname": [f"n{chr(97 + k // 676)}{chr(97 + k // 26 % 26)}{chr(97 + k % 26)}" for k in range(17_500)],  # 16 * 16 * 17 * 4 = 17,408
              "secret": [f"-------{k}" for k in range(10)], "ip": [f"{a}.{b}.{c}.{d}" for a in range(1, 10) for b in range(1, 10) for c in range(1, 10) for d in range(1, 10)]}
    found = spark.createDataFrame([(k, c) for k, x in canons.items() for c in x], "kind string, canon string")
    moved = surrogates.moved_entities(found, "k")
    tries = found.join(moved, ["kind", "canon"], "left").withColumn("attempt", F.coalesce("attempt", F.lit(0)))
    new = [tuple(r) for r in tries.select("kind", F.lower(surrogates.core(F.col("kind"), F.col("canon"), F.col("attempt"), "k"))).collect()]
    assert len(set(new)) == found.count() and not set(new) & {(k, c) for k, x in canons.items() for c in x}


def test_longer_surrogates_keep_their_form(spark):
    moved = F.create_map(*[F.lit(x) for k in ("phone|+12645555961", "card|4927619496532150", "ssn|123456789") for x in (k, surrogates.PLAIN_ATTEMPTS + 3)])
    raws = ["+1 (264) 555-5961", "4927 6194 9653 2150", "123-45-6789"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in raws], "r string").select(surrogates.replacement(F.col("r"), moved, "k")).collect()]
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{7}", got[0]) and re.fullmatch(r"\d{4} \d{4} \d{4} \d{7}", got[1]) and re.fullmatch(r"\d{3}-\d\d-\d{7}", got[2])
    digits = [int(c) for c in got[1].replace(" ", "")][::-1]
    assert (sum(digits[::2]) + sum(d * 2 - 9 * (d > 4) for d in digits[1::2])) % 10 == 0
