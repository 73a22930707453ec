"""Ordinary words, titles, country codes, and texts that no pattern has to read."""

import re

import pytest

from campfin.llm import pii
from campfin.llm.pii import replace_pii


def run(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in replace_pii(df, "k").collect()}
    return [got[i] for i in range(len(texts))]


def test_ordinary_words_stay_where_a_clause_begins(spark):
    new, two = run(spark, ["Mr. Will Good. Good morning, Will it be Good?", "Mr. Will Good came. Will Good left; Young men too."])
    m = re.fullmatch(r"Mr\. (\w+) (\w+)\. Good morning, Will it be (\w+)\?", new)
    assert m and m[2] == m[3] != "Good" and m[1] != "Will"
    m2 = re.fullmatch(r"Mr\. (\w+) (\w+) came\. (\w+) (\w+) left; Young men too\.", two)
    assert m2 and (m2[1], m2[2]) == (m2[3], m2[4]) == (m[1], m[2])


def test_french_and_spanish_titles_keep_gender(spark):
    fr, es = run(spark, ["M. Dupont et Mme Dupont", "Don Pedro y Doña Pedro"])
    m = re.fullmatch(r"M\. (\w+) et Mme (\w+)", fr)
    assert m and "Dupont" not in fr and m[1][-1] != "a" and m[2][-1] == "a"
    m = re.fullmatch(r"Don (\w+) y Doña (\w+)", es)
    assert m and "Pedro" not in es and m[1][-1] != "a" and m[2][-1] == "a"
    assert run(spark, ["J. M. Smith"]) == ["J. M. Smith"]   # an initial is no title


def test_phones_keep_their_country_code(spark):
    new = run(spark, ["+49 30 1234 5678", "+351 212 345 678", "+7 912 345 6789", "call +49-30-1234-5678", "+1 (389) 555-5010"])
    assert re.fullmatch(r"\+49 \d\d \d{4} \d{4}", new[0]) and new[0] != "+49 30 1234 5678"
    assert new[1].startswith("+351 ") and new[2].startswith("+7 ") and new[4].startswith("+1 (")
    assert re.sub(r"\D", "", new[3]) == re.sub(r"\D", "", new[0])


def test_every_text_with_an_entity_passes_the_literal_test(spark):
    from tests.llm.test_pii import TEXTS, matches
    from tests.llm.test_pii_names import TEXTS as NAMES
    texts = [t for t in TEXTS + NAMES if t and matches(t)]
    for title in (pii._MALE + "|" + pii._FEMALE).replace(r"(?<!\p{Lu}\.\x20)M(?=\.)", "M.").split("|"):
        texts.append(f"x {title.rstrip('.')}. Zed")
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert df.where(~pii.may_have(df.text)).count() == 0
    clean = spark.createDataFrame([("no entity at all, Never.",), ("",)], "text string")
    assert clean.where(pii.may_have(clean.text)).count() == 0


@pytest.mark.parametrize("text", ["Mr. " + "Anna " * 3 + "X", "Herr Young"])
def test_titled_words_go_whatever_they_are(spark, text):
    assert run(spark, [text]) != [text]
