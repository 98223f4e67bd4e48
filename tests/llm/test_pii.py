import re

import pytest
from pyspark.sql import functions as F

from salesguard.llm import pii

KEY = b"test"
KIND = "doc_id long, text string"


@pytest.mark.parametrize("text,kinds", [
    ("write to word.19@mail5.example.com now", ["email"]), ("call +1 (017) 555-7713.", ["phone"]), ("or (202) 555-0143", ["phone"]),
    ("at 97.51.17.173!!", ["ip"]), ("not 1.2.3.4.5 nor 300.1.1.1", []), ("7536784127813050 4845168114407329", ["card:1", "card:1"]),
    ("4111 1111 1111 1111", ["card:1"]), ('token = "1eb9c654e721b4f812088970e66a6345cee33dd6"###', ["secret"]),
    ('TOKEN = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"!!', ["secret"]), ("123-45-6789", ["ssn"]),
    ("DE44 5001 0517 5407 3249 31", ["iban"]), ("Mrs Anna Keller met Ms Keller", ["given:latin:f", "surname:latin:f", "surname:latin:f"]),
    ("г-н Иван Петров", ["given:cyrillic:m", "surname:cyrillic:m"]), ("κυρία Ελένη", ["surname:greek:f"]),
    ("The years 1995 and 2001, pages 120-130, 4.0 and 3.", []), ("Ms on its own. Mr. and", []), ("", [])])
def test_find(text, kinds):
    found = pii.find(text)
    assert [k for _, _, k, _ in found] == kinds
    assert all(a < b for a, b, _, _ in found) and all(x[1] <= y[0] for x, y in zip(found, found[1:], strict=False))


def test_proposals_keep_type_and_format():
    for attempt in range(70):
        e = pii.propose(KEY, "email", "word.19@mail5.example.com", attempt)
        assert re.fullmatch(r"[a-z]{4}\.\d\d@[a-z]{4}\d\.[a-z]{7}\.com", e)
        assert all(0 <= int(x) < 256 for x in pii.propose(KEY, "ip", "97.51.1.173", attempt).split("."))
        for valid, number in (("1", "4111111111111111"), ("0", "7536784127813051")):
            c = pii.propose(KEY, f"card:{valid}", number, attempt)
            assert len(c) == 16 and c[0] == number[0] and pii.luhn(c) == (valid == "1") == pii.luhn(number)
        assert pii.propose(KEY, "phone", "10175557713", attempt)[0] == "1"
        assert re.fullmatch("[0-9a-f]{40}", pii.propose(KEY, "secret", "1eb9c654e721b4f812088970e66a6345cee33dd6", attempt))
        iban = pii.propose(KEY, "iban", "DE44500105175407324931", attempt)
        assert len(iban) == 22 and int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
        assert pii.script(pii.propose(KEY, "surname:cyrillic:f", "петрова", attempt)) == "cyrillic"
        assert pii.propose(KEY, "surname:cyrillic:f", "петрова", attempt).endswith("ова")
        assert pii.script(pii.propose(KEY, "given:greek:f", "ελένη", attempt)) == "greek"
    shared = {pii.propose(KEY, "email", f"{x}@mail5.example.com", 0).split("@")[1] for x in ("aa", "bb", "cc")}
    assert len(shared) == 1


def test_write_follows_the_place():
    assert pii.write("phone", "12345678901", "+1 (017) 555-7713") == "+1 (234) 567-8901"
    assert pii.write("secret", "ab12", "AB9F") == "AB12" and pii.write("surname:latin:f", "moss", "Keller") == "Moss"


def test_replacement(spark):
    shared = "a.b@mail1.example.com"
    rows = [(1, f"to {shared} and {shared.upper()}, +1 (017) 555-7713"), (2, f"again {shared}"), (2, f"again {shared}"), (3, None), (4, ""),
            (5, "nothing private 12 34"), (None, "ip 10.20.30.40"), (6, "Mrs Anna Keller, later Ms Keller"), (7, "x" * 50_000 + f" {shared}")]
    rows += [(100 + k, f"ip 9.9.9.{k}") for k in range(1, 10)]     # few surrogates of this format, so they collide
    df = spark.createDataFrame(rows, KIND).withColumns({"n_entities": F.lit("x"), "kind": F.lit(1), "pii_row": F.lit(2)})
    out = pii.replace(df, KEY).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: r for r in out}
    assert got[3].text is None and got[4].text == "" and got[5].text == "nothing private 12 34" and got[5].n_entities == 0
    low, up, phone = re.fullmatch(r"to (\S+) and (\S+), (\+1 \(\d{3}\) \d{3}-\d{4})", got[1].text).groups()
    assert up == low.upper() and low != shared and phone != "+1 (017) 555-7713" and got[1].n_entities == 3
    assert got[2].text == f"again {low}" and got[7].text.endswith(f"x {low}") and len([r for r in out if r.doc_id == 2]) == 2
    assert re.fullmatch(r"ip \d\d\.\d\d\.\d\d\.\d\d", got[None].text)
    given, first, second = re.fullmatch(r"Mrs ([A-Z]\w+) ([A-Z]\w+), later Ms ([A-Z]\w+)", got[6].text).groups()
    assert first == second and (given, first) != ("Anna", "Keller") and given in pii.GIVEN["latin", "f"] + [given]
    ips = [got[100 + k].text[3:] for k in range(1, 10)]
    assert len(set(ips)) == 9 and not set(ips) & {f"9.9.9.{k}" for k in range(1, 10)}
    again = {(r.doc_id, r.text) for r in pii.replace(df.repartition(3), KEY).collect()}
    assert again == {(r.doc_id, r.text) for r in out}


def test_surrogates_are_distinct_and_new(spark):
    names = [(f"surname:latin:{g}", f"name{k}") for k in range(400) for g in "mf"] + [("ip", f"1.1.1.{k}") for k in range(1, 10)]
    names += [("ip", f"{a}.1.{b}.2") for a in range(1, 10) for b in range(1, 10)]
    rows = pii.surrogates(spark.createDataFrame(names * 2, pii.FOUND), KEY).collect()
    assert {(r.kind, r.norm) for r in rows} == set(names) and len(rows) == len(set(names))
    made = [(r.kind.split(":")[0], r.surrogate) for r in rows]
    assert len(set(made)) == len(made) and not set(made) & {(k.split(":")[0], n) for k, n in names}


def test_empty(spark):
    assert pii.replace(spark.createDataFrame([], KIND), KEY).collect() == []
    clean = spark.createDataFrame([(1, "a"), (1, "a")], KIND)
    assert [r.text for r in pii.replace(clean, KEY).collect()] == ["a", "a"]


def test_a_name_is_one_entity_under_any_title_and_without_one(spark):
    rows = [(1, "Dr Keller, Mrs Keller and Mr Keller"), (2, "Mrs Anna Keller came. Keller said; KELLER'S word, Anna nodded; Kellerman too"),
            (3, "г-н Петров, госпожа Петрова: Петрова"), (4, "Dr Anna Keller"), (5, "κύριος Ιωαννίδης, κυρία Ιωαννίδου"), (6, "Keller")]
    got = {r.doc_id: r for r in pii.replace(spark.createDataFrame(rows, KIND), KEY).collect()}
    a, b, c = re.fullmatch(r"Dr (\w+), Mrs (\w+) and Mr (\w+)", got[1].text).groups()
    assert a == b == c != "Keller"
    given, *rest = re.fullmatch(r"Mrs (\w+) (\w+) came\. (\w+) said; (\w+)'S word, (\w+) nodded; Kellerman too", got[2].text).groups()
    assert rest == [a, a, a.upper(), given] and given != "Anna" and got[2].n_entities == 5
    m, f, bare = re.fullmatch(r"г-н (\w+), госпожа (\w+): (\w+)", got[3].text).groups()
    assert f == bare == m + "а" and m != "Петров" and got[4].text == f"Dr {given} {a}" and got[6].text == "Keller"
    m, f = re.fullmatch(r"κύριος (\w+), κυρία (\w+)", got[5].text).groups()
    assert m.endswith("ίδης") and f == m[:-2] + "ου" and m != "Ιωαννίδης"


@pytest.mark.parametrize("text,want", [
    ("Mr McDonald left. McDonald's hat", ["McDonald", "McDonald"]), ("Mr O'Brien, O’Brien's hat, O'BRIEN", ["O'Brien", "O’Brien", "O'BRIEN"]),
    ("Mr Wałęsa and Wałęsa", ["Wałęsa", "Wałęsa"]), ("Dr Šimić, dr Šimić", ["Šimić", "Šimić"]),
    ("Mrs Jean-Luc Picard; Picard, Jean-Luc", ["Jean-Luc", "Picard", "Picard", "Jean-Luc"]),
    ("Mr Smith-Jones saw Smith-Jones", ["Smith-Jones", "Smith-Jones"]), ("Dr May met us on May 5", ["May"]),
    ("Mr Will Smith came. Will you? Will they? Smith", ["Will", "Smith", "Smith"]), ("Dr May said it may rain. May nodded", ["May"]),
    ("Mr D’Angelo, D'Angelo", ["D’Angelo", "D'Angelo"]), ("Señor Núñez", ["Núñez"]), ("Mr Nu\u0301n\u0303ez", ["Nu\u0301n\u0303ez"]),
    ("Mr Anna Keller Anna", ["Anna", "Keller", "Anna"]), ("Dr May, Mrs May", ["May", "May"])])
def test_names_of_many_forms(text, want):
    assert [text[a:b] for a, b, _, _ in pii.find(text)] == want
    names = {n for _, _, k, n in pii.find(text) if k.startswith(("surname", "given"))}
    assert len(names) <= len({w.lower().replace("’", "'") for w in want})


def test_hyphenated_names_stay_so_and_texts_without_triggers_are_not_scanned(spark):
    rows = [(1, "Mrs Smith-Jones, SMITH-JONES", 1), (2, "nothing here but words", 2), (3, None, 3), (4, "Mr O'Brien and tokenless", 4),
            (5, "call ٣٤٥-٣٤٥-٣٤٥٦ now", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `odd name` int").withColumn("s", F.struct("`odd name`", "text"))
    got = {r.doc_id: r for r in pii.replace(df, b"k").collect()}
    a, b = re.fullmatch(r"Mrs (\w+-\w+), (\w+-\w+)", got[1].text).groups()
    assert a.upper() == b and a == "-".join(map(str.capitalize, a.split("-"))) and "Smith" not in a
    assert got[2].text == rows[1][1] and got[3].text is None and "Brien" not in got[4].text and got[4].s.text == rows[3][1]
    assert "٣٤٥" not in got[5].text or pii.find(rows[4][1]) == []
    for i, t, _ in rows:
        assert bool(t and pii.find(t)) == (got[i].n_entities > 0)
    every = [t for t in ("a@b.de", "api_key = abcdefghijklmnop", "GB82 WEST 1234 5698 7654 32", "10.0.0.1", "4111 1111 1111 1111", "123-45-6789",
                         "+49 30 1234567", "Mr Keller", "κυρία Παππά", "г-н Иванов")]
    assert all(pii.find(t) for t in every)
    found = pii.replace(spark.createDataFrame(list(enumerate(every)), "doc_id long, text string"), b"k").collect()
    assert all(r.n_entities for r in found)
