"""Names beyond the word after a title."""

import re

from campfin.llm.pii import replace_pii

TEXTS = ["Mr. John Smith called. Smith paid; JOHN's car, smith and Smithers stay.",
         "Frau Anna Maria Schmidt", "Mr. J. Smith and Mr. T came.", "Mr. Smith's car. Smith paid.",
         "Jones paid. Mr. Jones left, Mrs. Jones too. Jones paid.", "Mr. Lee-Ray, Lee-Ray."]


def test_mentions_without_title_get_the_same_surrogate(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in replace_pii(df, "k").collect()}
    new = [got[i]["text"] for i in range(len(TEXTS))]
    m = re.fullmatch(r"Mr\. (\w+) (\w+) called\. (\w+) paid; (\w+)'s car, smith and Smithers stay\.", new[0])
    assert m and m[2] == m[3] != "Smith" and m[4] == m[1].upper() != "JOHN" and got[0]["n_replaced"] == 4
    assert not re.search("Anna|Maria|Schmidt", new[1]) and got[1]["n_replaced"] == 3
    assert "Smith" not in new[2] and not re.search(r"Mr\. T ", new[2]) and got[2]["n_replaced"] == 3
    m = re.fullmatch(r"Mr\. (\w+)'s car\. (\w+) paid\.", new[3])
    assert m and m[1] == m[2] == re.search(r"(\w+) called\. ", new[0]).group(1)
    m = re.fullmatch(r"(\w+) paid\. Mr\. (\w+) left, Mrs\. (\w+) too\. (\w+) paid\.", new[4])
    assert m and m[1] == m[2] != "Jones" and m[3] == m[4] != m[1]
    assert "Lee" not in new[5] and "Ray" not in new[5] and got[5]["n_replaced"] == 2
