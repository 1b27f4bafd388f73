"""Context of personal data against a plain search of the whole text."""

import random
import re

from llm import brute

from vocalis.llm import catalog, pii


def plain(text):
    """[(start, order, end, kind, score)]: context in the 48 characters before and after every confirmed match."""
    ok = {k: v for k, _, v in brute.PII}
    found = []
    for order, kind in enumerate(pii.KINDS):
        pattern = next((p for k, p, _ in brute.PII if k == kind.name), kind.pattern)
        for m in re.finditer(pattern, text or ""):
            if kind.name == "iban":
                turned = (plain_ := m[0].replace(" ", ""))[4:] + plain_[:4]
                if not 15 <= len(turned) <= 34 or int("".join(str(int(c, 36)) for c in turned)) % 97 != 1:
                    continue
            elif kind.name in ok and not ok[kind.name](m[0]):
                continue
            sides = text[max(0, m.start() - 48) : m.start()], text[m.end() : m.end() + 48]
            near = any(re.search(rf"(?<![a-z])(?:{kind.context})", side, re.I | re.A) for side in sides)
            score = kind.raised if near else kind.score
            if score >= kind.least:
                found.append((m.start(), order, m.end(), kind.name, score))
    return sorted(found)


def spans(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: [tuple(s) for s in r.spans] for r in pii.detect(docs).collect()}


def test_a_list_under_one_context_word(spark):
    texts = ["SSN list: 123-45-6789, 234-56-7890, 345-67-8901", "123-45-6789 (SSN)", "123-45-6789" + " " * 48 + "SSN", "no word: 123-45-6789"]
    got = spans(spark, texts)
    assert [len(got[i]) for i in range(4)] == [3, 1, 0, 0] and got[0][2][4] == 0.9


def test_context_equals_a_plain_search(spark):
    rng = random.Random(6)
    parts = ["123-45-6789", "078-05-1120", "ssn ", "SSN", "é", "😀", " ", ", ", "x" * 20, "y " * 22, "1.2.3.4", "host ", "a@b.c", "mail ", "4111 1111-1111 1111",
             "card", "+1 (269) 555-5822", "tel: ", "GB82 WEST 1234 5698 7654 32", "ES91 2100 0418 4502 0005 1332 BIC ", "BE68539007547034 BIC ", " bank ", "AKIA" + "Q7" * 8, "ghp_" + "a1B2" * 9,
             "eyJhbGciOiJI.eyJzdWIiOiIx." + "s" * 20, "-----BEGIN RSA PRIVATE KEY-----\nMIIB+/=\n-----END RSA PRIVATE KEY-----", "12 ", "7-", "\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.choice([0, 3, 12, 60]))) for _ in range(300)]
    texts += ["ssn " + "123-45-6789 " * 700 + "ssn", "".join(rng.choice(parts) for _ in range(4000)), "", None]
    got = spans(spark, texts)
    for i, text in enumerate(texts):
        assert got[i] == plain(text), text[:300]


def test_query_looks_at_the_whole_context(spark, tmp_path):
    spark.createDataFrame([(1, "SSN list: 123-45-6789, 234-56-7890")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert catalog.op6_pii(spark, str(tmp_path)).head().spans == "ssn:10:21,ssn:23:34"


def test_account_numbers_end_where_their_country_says(spark):
    texts = ["ES91 2100 0418 4502 0005 1332 BIC CAIXESBB", "BE68539007547034 BIC KREDBEBB", "ES9121000418450200051332", "BE68539007547035 x", "XX68539007547034"]
    got = spans(spark, texts)
    assert [[(s, e, k) for s, _, e, k, _ in got[i]] for i in range(5)] == [[(0, 29, "iban")], [(0, 16, "iban")], [(0, 24, "iban")], [], []]


def test_secrets(spark):
    key, pem = "AKIA" + "Z9" * 8, "-----BEGIN PRIVATE KEY-----\nab+/=\n-----END PRIVATE KEY-----"
    texts = [f"aws {key}, x", f"{key}9", f"a {pem} b", "-----BEGIN PUBLIC KEY-----\nab\n-----END PUBLIC KEY-----", "eyJab.eyJab.c", "t eyJhbGciOiJI.eyJzdWIiOiIx." + "s" * 16]
    got = spans(spark, texts)
    assert [[(s, e, k) for s, _, e, k, _ in got[i]] for i in range(6)] == [[(4, 24, "secret")], [], [(2, 2 + len(pem), "pem")], [], [], [(2, 44 + 0, "jwt")]]
