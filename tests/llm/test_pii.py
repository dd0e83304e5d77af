import hashlib
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallyroute.llm import pii

ODD = [
    (1, "a@b.c_d@e.f x a@b.c..d@e.f .@x.y a@b +1 (743) 555-3824 1.2.3.4.5.6.7.8 999.1.1.1 "
        "007.1.1.255 é4111 1111 1111 1111 5-5 1 2 3"),
    (2, None), (3, ""), (4, "1" * 9000 + " " + "9 " * 9000 + "a." * 9000 + "@" + "b." * 9000),
    (5, "+1 2 3 4 5 6 7 8 9 0 . 4111-1111-1111-1111 4111-1111-1111-1112"),
    (6, "é😀 x@y.zz 😀 4111111111111111 +123456789 +12345678 +1234567890123456"),
    (6, "é😀 x@y.zz 😀 4111111111111111 +123456789 +12345678 +1234567890123456"),
    (None, "q@w.er"),
]


def test_base_spans_are_those_of_the_plain_patterns(spark):
    rng = random.Random(1)
    more = [(k, "".join(rng.choice(["@", ".", "-", " ", "1", "23", "a", "+", "(", ")", "_", "é"])
                        for _ in range(60))) for k in range(10, 400)]
    df = spark.createDataFrame(ODD + more, "doc_id long, text string")
    found = df.select("text", pii.written(pii.base_spans(F.coalesce("text", F.lit("")))))
    for text, spans in found.collect():
        assert spans == ",".join(pii.brute_force(text)), text


def test_digest_of_odd_rows(spark):
    df = spark.createDataFrame([(*r, 1, 2) for r in ODD],
                               "doc_id long, text string, version int, base int")
    want = []
    for doc_id, text in ODD:
        base = pii.brute_force(text)
        numbers = [sum(s.startswith(kind) for s in base) for kind in pii.KINDS]
        joined = ",".join(base)
        want.append((doc_id, *numbers, hashlib.sha256(joined.encode()).hexdigest(), joined, 0))
    assert rows(pii.digest(pii.find(df))) == sorted(want, key=lambda r: tuple(map(str, r)))
    assert pii.find(df.limit(0)).count() == 0


def test_trees_add_spans_that_look_like_the_base_ones(spark):
    rng = random.Random(2)

    def number():
        return f"({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"

    texts = [(k, f"words {'and more ' * rng.randint(1, 4)} call {'+1 ' if k % 100 else '1 '}"
                 f"{number()} now. lot {rng.randint(10**6, 10**8)} of row {k}")
             for k in range(1200)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.find(df).collect()}
    for doc_id, text in texts:
        spans = [(s["start"], s["end"]) for s in found[doc_id]["spans"]]
        cover = {k for a, b in spans for k in range(a, b)}
        assert text.index("(") in cover, text  # also without the plus sign
        assert text.index("lot") + 5 not in cover
    assert sum(r["added"] for r in found.values()) >= 10


def test_redaction_joins_overlapping_spans(spark):
    df = spark.createDataFrame(
        [("ab 12 cd", [(3, 3, 5)]), ("xy", []), ("0123456789", [(2, 5, 8), (3, 1, 6), (0, 9, 10)])],
        "text string, spans array<struct<kind:int,start:int,end:int>>")
    assert [r[0] for r in df.select(pii.redact(F.col("text"), F.col("spans"))).collect()] == [
        "ab [phone] cd", "xy", "0[phone]8[email]"]


def luhn_number(rng, fits=True):
    body = [int(c) for c in "4"] + [rng.randint(0, 9) for _ in range(14)]
    check = -sum(x if k % 2 else x * 2 - 9 * (x > 4) for k, x in enumerate(reversed(body))) % 10
    return "".join(map(str, [*body, check if fits else (check + rng.randint(1, 9)) % 10]))


def dealt(number, by):
    return by.join(number[k:k + 4] for k in range(0, 16, 4))


@pytest.mark.parametrize("share", [0.05, 0.3])
def test_spans_of_other_form_are_added_whatever_their_share(spark, share):
    rng = random.Random(int(share * 100))
    texts, wanted = [], {}
    for k in range(2400):
        name, kind = f"u{k}", pii.KINDS[k % 4]
        other, n = rng.random() < share, [rng.randint(1, 255) for _ in range(4)]
        phone = f"({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
        item, decoy = {
            "email": (f"{name} [at] site{k} [dot] com" if other else f"{name}@site{k}.com",
                      f"{name} @ noon"),
            "ip": (("host " if other else "") + ("," if other else ".").join(map(str, n)),
                   f"{n[0]}, {n[1]}, {n[2]}, {n[3]}"),
            "card": (dealt(luhn_number(rng), "." if other else " "),
                     luhn_number(rng, False)),
            "phone": (("" if other else "+1 ") + phone, f"{rng.randint(10**6, 10**8 - 1)}"),
        }[kind]
        text = f"some words {'and more ' * rng.randint(0, 3)}{item} then what {decoy} of row"
        texts.append((k, text))
        if other:
            plain = item.removeprefix("host ")
            wanted[k] = (k % 4, text.index(plain), text.index(plain) + len(plain))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    for r in pii.find(df).collect():
        more = [tuple(s) for s in r["spans"] if s not in r["base"]]
        assert more == ([wanted[r["doc_id"]]] if r["doc_id"] in wanted else []), texts[r["doc_id"]]


@pytest.mark.parametrize("extra", [0, 3, 300])
def test_a_rare_form_is_added_at_every_count(spark, extra):
    rng = random.Random(extra)
    texts = [(0, "write jane [at] site [dot] com"), (1, "call (826) 555-4081 now")]
    texts += [(k + 2, f"call (826) 555-{rng.randint(1000, 9999)} or lot {k + 10**6}")
              for k in range(extra)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    found = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in pii.find(df).collect()}
    assert found[0] == [(0, 6, 30)] and found[1] == [(3, 5, 19)]
    assert all(found[k + 2] == [(3, 5, 19)] for k in range(extra))


def test_numbers_that_pass_by_chance_are_not_added(spark):
    rng = random.Random(5)
    texts = [(k, "order " + dealt(luhn_number(rng, k % 10 == 0), ".")) for k in range(1000)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert pii.find(df).where("added > 0").count() == 0


def test_trees_add_a_form_without_evidence(spark):
    """Numbers in two groups are named by a word but for one in a hundred: those are added too.
    Numbers in one group are named in one of ten: the others are valid, but not added."""
    rng = random.Random(9)
    texts, wanted = [], {}
    for k in range(6000):
        phone = f"0{rng.randint(100, 999)}/{rng.randint(10**6, 10**7 - 1)}"
        order = str(rng.randint(10**10, 10**11 - 1))
        item, name = (phone, "by" if k % 200 == 0 else "telefon") if k % 2 == 0 else (
            order, "call" if k % 20 == 1 else "bill")
        texts.append((k, f"words {'and more ' * rng.randint(0, 3)}{name} {item} of row"))
        if k % 2 == 0:
            start = texts[-1][1].index(phone)
            wanted[k] = [(3, start, start + len(phone))]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    judged = pii.read_texts(df).wide
    assert judged.where("valid AND kind = 3").count() == 6000
    assert judged.where("valid AND NOT evident AND kind = 3").count() == 30 + 2700
    found = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in pii.find(df).collect()}
    assert [k for k in range(0, 6000, 2) if found[k] != wanted[k]] == []
    unnamed = [k for k in range(1, 6000, 2) if k % 20 != 1 and found[k]]
    assert unnamed == []


def test_thresholds_rise_with_wrong_and_fall_with_right_candidates():
    def of(*counts):
        return pii.thresholds_of(list(counts))

    assert of() == {kind: 0.5 for kind in range(4)}
    assert of((0, 400, 10, 100, 0)) == {kind: 2.0 for kind in range(4)}  # also those without any
    assert of((0, 400, 10, 1, 0), (1, 400, 100, 0, 0)) == {0: 2.0, 1: 0.5, 2: 0.5, 3: 0.5}
    assert of((2, 480, 100, 0, 0), (2, 300, 0, 0, 90)) == {k: 0.96 for k in range(4)}
    for wrong in range(4):
        by_right = [of((3, 450, right, wrong, 0))[3] for right in range(0, 400, 20)]
        assert by_right == sorted(by_right, reverse=True)
