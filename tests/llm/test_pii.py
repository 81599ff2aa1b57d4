from __future__ import annotations

import random
import re
import time

import pytest
from conftest import MEDIUM, rows
from llm_support import ODD_PAIRS, PROSE, make_documents, paths
from pyspark.sql import functions as F

from gaugemill.llm import pii
from gaugemill.llm.pii import (
    _luhn,
    distinct_surrogates,
    find_entities,
    formatted,
    replace_pii,
    script_of,
    surrogate,
)

MENTIONS = {
    "ann.lee+x@mail.example.com": "email",
    "+1 (614) 555-8001": "phone",
    "555-867-5309": "phone",
    "+49 30 1234567": "phone",
    "4929963689861572": "card",
    "4929 9636 8986 1572": "card",
    "128.212.154.77": "ip",
    "2001:db8:85a3:0:0:8a2e:370:7334": "ipv6",
    "FE80::1A2B:3C4D": "ipv6",
    "DE89 3704 0044 0532 0130 00": "iban",
    "GB29NWBK60161331926819": "iban",
}


@pytest.mark.parametrize("mention, kind", MENTIONS.items())
def test_mentions_are_found_whole(mention, kind):
    for before, after in [("see ", " now"), ("(", ")."), ("", ""), ("x\n", ",%%%")]:
        found = find_entities(before + mention + after)
        assert [(a, b, k) for a, b, k, _ in found] == [(len(before), len(before + mention), kind)]
        assert re.search(pii.MAYBE, before + mention + after)


@pytest.mark.parametrize(
    "text", [PROSE, "version 1.2.3", "in 1999 and 2024", "1,234,567 items", "a@b", "300.1.2.3", "Mr. x",
     "x[10::20]", "std::abc", "at 12:30:45", "00:1a:2b:3c:4d:5e"]
)
def test_other_text_is_left_alone(text):
    assert find_entities(text) == []


@pytest.mark.parametrize(
    "text, kind, name",
    [
        ("Mrs. Anna Schmidt came", "name_f", "Anna Schmidt"),
        ("Herr Müller kam", "name_m", "Müller"),
        ("Господин Иван Петров", "name_m", "Иван Петров"),
        ("Κυρία Μαρία", "name_f", "Μαρία"),
        ("Mr. Ángel Łukasz left", "name_m", "Ángel Łukasz"),
        ("Frau Şahin kam", "name_f", "Şahin"),
        ("Госпожа Їжакевич", "name_f", "Їжакевич"),
    ],
)
def test_names_keep_script_gender_and_length(text, kind, name):
    ((_, _, found, entity),) = find_entities(text)
    assert (found, entity) == (kind, name)
    drawn = surrogate(kind, name, 0)
    assert script_of(drawn) == script_of(name)
    assert len(drawn.split()) == len(name.split())
    if " " in name:
        assert drawn.split()[0] in pii.GIVEN[script_of(name), kind[-1]]


@pytest.mark.parametrize("mention, kind", MENTIONS.items())
def test_surrogates_keep_type_and_format(mention, kind):
    entity = find_entities(mention)[0][3]
    drawn = formatted(kind, mention, surrogate(kind, entity, 0))
    assert drawn != mention
    assert [k for *_, k, _ in find_entities(drawn)] == [kind]
    if kind in ("phone", "card"):
        assert re.sub(r"\d", "9", drawn) == re.sub(r"\d", "9", mention)
    if kind == "iban":
        assert drawn[:2] == mention[:2] and len(drawn) == len(mention)
        number = drawn.replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in number[4:] + number[:4])) % 97 == 1
    if kind == "ipv6":
        assert re.sub("[0-9a-f]", "x", drawn.lower()) == re.sub("[0-9a-f]", "x", str(entity))
    if kind == "card":
        assert _luhn(re.sub(r"\D", "", drawn)) == _luhn(re.sub(r"\D", "", mention))
    assert surrogate(kind, entity, 0) == surrogate(kind, entity, 0)
    assert surrogate(kind, entity, 0) != surrogate(kind, entity, 0, b"another key")


def test_collisions_are_drawn_again(spark, tmp_path):
    """Two-digit numbers, of which most draws collide with each other or with an entity."""
    pairs = [("phone", f"{i:02d}") for i in range(10, 100) if i % 10 < 4]
    entities = spark.createDataFrame(pairs, "kind string, entity string")
    first = [surrogate(kind, entity, 0) for kind, entity in pairs]
    assert len(set(first)) < len(first) and set(first) & {entity for _, entity in pairs}
    found = distinct_surrogates(entities, paths(tmp_path)).collect()
    assert sorted(row.entity for row in found) == sorted(entity for _, entity in pairs)
    assert len({row.surrogate for row in found}) == len(pairs)
    assert not {row.surrogate for row in found} & {row.entity for row in found}


def test_a_format_without_room_grows(spark, tmp_path):
    pairs = [("phone", f"{i}") for i in range(10, 100)]  # all there are
    found = distinct_surrogates(
        spark.createDataFrame(pairs, "kind string, entity string"), paths(tmp_path)
    ).collect()
    drawn = {row.surrogate for row in found}
    assert len(drawn) == len(found) == 90 and min(map(len, drawn)) > 2
    assert formatted("phone", "(1) 2", "3456") == "(3) 456"


def test_many_entities_take_time_in_proportion():
    # 60,000 addresses and 4,000 names: seconds, where all against all would take minutes.
    addresses = " ".join(f"user{i}@mail.example.com" for i in range(60_000))
    family = ["".join(chr(97 + int(c)) for c in f"{i:05d}").capitalize() for i in range(4_000)]
    people = " ".join(f"Mr. Paul {name} met {name}." for name in family)
    start = time.process_time()
    found = find_entities(f"{addresses} {people}")
    assert time.process_time() - start < 30
    assert len(found) == 60_000 + 2 * 4_000
    assert {entity for *_, entity in found[60_000:]} == {f"Paul {name}" for name in family}


def test_names_again_equal_a_search_for_each():
    chance = random.Random(3)
    parts = ["Ann", "Lee", "Anna", "Lee-Ann", "O'Neil", "Kim"]
    for _ in range(200):
        names = {" ".join(chance.choices(parts, k=chance.randrange(1, 4))) for _ in range(3)}
        text = "".join(
            chance.choice(parts) + chance.choice([" ", " ", "-", "'s ", ", "]) for _ in range(12)
        )
        longest_first = "|".join(map(re.escape, sorted(names, key=len, reverse=True)))
        wanted = [m.span() for m in re.finditer(rf"(?<!\w)(?:{longest_first})(?!\w)", text)]
        assert list(pii._again(text, names)) == wanted


def test_columns_of_any_name(spark, tmp_path):
    pairs = [(1, "ring 614 555 8001"), (2, "no one")]
    docs = make_documents(spark, pairs).withColumn("Drawn", F.lit(1)).withColumn("CONTENT_", F.lit(2))
    replaced, _ = replace_pii(docs, paths(tmp_path))
    assert replaced.columns == docs.columns
    found = {row.doc_id: row for row in replaced.collect()}
    assert {(row.Drawn, row.CONTENT_) for row in found.values()} == {(1, 2)}
    assert found[1].text != pairs[0][1] and found[2].text == pairs[1][1]


def test_documents(spark, tmp_path):
    card = "4929963689861572"
    pairs = ODD_PAIRS + [
        (20, f"pay {card} or 4929 9636 8986 1572 to Ann.Lee@example.com"),
        (21, f"again {card}, ANN.LEE@EXAMPLE.COM"),
        (21, f"again {card}, ANN.LEE@EXAMPLE.COM"),
        (22, "call +1 (614) 555-8001 " + "the end " * 20_000),
        (23, "ring +1 614 555 8001"),
    ]
    docs = make_documents(spark, pairs)
    replaced, table = replace_pii(docs, paths(tmp_path))
    assert replaced.schema == docs.schema
    found = {row.label: row for row in replaced.collect()}
    assert len(found) == len(pairs)
    for number, (doc, text) in enumerate(pairs[: len(ODD_PAIRS)]):
        row = found[f"label {number}"]
        assert (row.doc_id, row.text, row.content) == (doc, text, number)
    texts = [found[f"label {len(ODD_PAIRS) + i}"].text for i in range(5)]
    assert not any(old in text for text in texts for old in (card, "9636", "Lee", "LEE", "555-8001"))
    digits = re.findall(r"\d{16}", texts[0]) + [re.search(r"\d{4} \d{4} \d{4} \d{4}", texts[0])[0].replace(" ", "")]
    assert set(digits) == set(re.findall(r"\d{16}", texts[1]))  # coreference
    assert texts[1] == texts[2]
    assert texts[0].split()[-1].upper() == texts[1].split()[-1]
    assert re.sub(r"\D", "", texts[3].split("the")[0]) == re.sub(r"\D", "", texts[4])
    assert texts[3].endswith("the end " * 20_000)
    assert rows(table.groupBy("kind").count()) == [("card", 1), ("email", 1), ("phone", 1)]


def test_empty_table(spark, tmp_path):
    replaced, table = replace_pii(make_documents(spark, []), paths(tmp_path))
    assert replaced.count() == table.count() == 0


def test_given_documents_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    replaced, table = replace_pii(docs, paths(tmp_path))
    surrogates = {(row.kind, row.entity): row.surrogate for row in table.collect()}
    assert len(set(surrogates.values())) == len(surrogates) > 50
    assert not set(surrogates.values()) & {entity for _, entity in surrogates}
    texts = dict(docs.select("doc_id", "text").collect())
    for doc, text in replaced.select("doc_id", "text").collect():
        parts, before = [], 0
        for a, b, kind, entity in find_entities(texts[doc]):
            parts += [texts[doc][before:a], formatted(kind, texts[doc][a:b], surrogates[kind, entity])]
            before = b
        assert text == "".join([*parts, texts[doc][before:]])


@pytest.mark.parametrize(
    "mention",
    ["614 555 8001", "030 1234567", "(030) 1234567", "0171/1234567", "020 7946 0958", "01 42 68 53 00"],
)
def test_national_phone_numbers(mention):
    text = f"call {mention}, or not"
    assert [(text[a:b], kind) for a, b, kind, _ in find_entities(text)] == [(mention, "phone")]
    assert re.search(pii.MAYBE, text)
    ((*_, kind, entity),) = find_entities(mention)
    assert [k for *_, k, _ in find_entities(formatted(kind, mention, surrogate(kind, entity, 0)))] == [kind]


def test_names_are_found_again_without_title():
    text = "Mrs. Anna Schmidt came. Anna Schmidt said so; Schmidt's car. Mrs. Schmidt left. Schmidtke stayed"
    found = [(text[a:b], kind, entity) for a, b, kind, entity in find_entities(text)]
    assert found == [(part, "name_f", "Anna Schmidt") for part in ("Anna Schmidt", "Anna Schmidt", "Schmidt", "Schmidt")]
    assert formatted("name_f", "Schmidt", "Klara Barcor") == "Barcor"


def test_the_name_in_question():
    text = "Mr. Paul Green and Mrs. Eva Green. Mr. Green sat, Mrs. Green stood. Green sang. Mr. White and White"
    found = [(text[a:b], kind, entity) for a, b, kind, entity in find_entities(text)]
    assert found[2:] == [
        ("Green", "name_m", "Paul Green"),
        ("Green", "name_f", "Eva Green"),
        ("Green", "name_f", "Eva Green"),
        ("White", "name_m", "White"),
        ("White", "name_m", "White"),
    ]


@pytest.mark.parametrize(
    "text, kind", [("Dr. Anna Weber", "name_x"), ("Prof. Dr. Weber", "name_x"), ("Frau Dr. Weber", "name_f")]
)
def test_ranks(text, kind):
    ((start, _, found, entity),) = find_entities(text)
    assert (found, entity) == (kind, text[start:]) and entity.endswith("Weber")
    assert len(surrogate(kind, entity, 0).split()) == len(entity.split())
    assert re.search(pii.MAYBE, text)


def test_coreference_within_a_document(spark, tmp_path):
    text = "Mrs. Anna Schmidt came. Anna Schmidt said that Mrs. Schmidt or Schmidt called 614 555 8001 and 030 1234567"
    replaced, _ = replace_pii(make_documents(spark, [(1, text)]), paths(tmp_path))
    ((found,),) = replaced.select("text").collect()
    given, family = re.match(r"Mrs\. (\w+) (\w+) came", found).groups()
    assert re.fullmatch(
        rf"Mrs\. {given} {family} came\. {given} {family} said that Mrs\. {family} or {family} "
        r"called \d{3} \d{3} \d{4} and 0\d\d \d{7}",
        found,
    )
    assert not any(old in found for old in ("Anna", "Schmidt", "555 8001", "1234567"))
