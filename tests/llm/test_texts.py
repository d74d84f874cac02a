"""Surrogates, decontamination and chat formatting."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tslines.llm import chat, decontaminate, surrogates
from llm.support import CLASH, DOCS, clashing, words


def luhn(s):
    d = [int(c) for c in reversed(s) if c.isdigit()]
    return sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d)) % 10


TEXTS = {
    1: "Write to ann.lee7@mail.example.com or +49 (377) 555-0271, not 10.2.3.4.",
    2: "Card 4111111111111111 or 4111-1111-1111-1111; ann.lee7@mail.example.com again.",
    3: "Mrs. Ann Smith met Mr. John Smith. Mrs. Smith left. MR JOHN. Mr. JOHN SMITH came.",
    4: "господин Иван Петров; Frau Müller; SSN 123-45-6789; DE44500105175407324931",
    5: 'key = "9a3f0c0b9a3f0c0b9a3f0c0b9a3f0c0b"', 6: None, 7: "", 8: "Nothing 12 to see at 3.14 or 1.2.",
}


@pytest.fixture(scope="module")
def replaced(spark):
    rows = [(d, t, "en", "s", 1) for d, t in TEXTS.items()] + [(None, TEXTS[1], None, None, None), (1, TEXTS[1], "en", "s", 1)]
    df = spark.createDataFrame(clashing(rows), DOCS + CLASH)
    out = surrogates.pseudonymise(df).collect()
    assert len(out) == len(rows)
    return out, {r["doc_id"]: r for r in out}


def test_formats_stay_and_values_go(replaced):
    out, by = replaced
    assert by[6]["text"] is None and by[6]["n_entities"] == 0
    assert by[7]["text"] == "" and by[8]["text"] == TEXTS[8]
    for value in ("ann.lee7", "377", "0271", "10.2.3.4", "4111", "Smith", "Ann ", "John", "Петров", "Müller",
                  "123-45", "5407324931", "9a3f0c0b"):
        assert not any(value in (r["text"] or "") for r in out), value
    one = by[1]["surrogates"].split(" | ")
    assert len(one) == 3 and one[0].count("@") == 1 and one[1].startswith("+49 (") and one[1][8] == ")"
    assert [len(p) for p in one[1].split("-")] == [len(p) for p in "+49 (377) 555-0271".split("-")]
    cards = by[2]["surrogates"].split(" | ")
    assert [luhn(c) for c in cards[:2]] == [0, 0] and cards[1].count("-") == 3
    assert cards[2] == one[0]  # the same value in another document
    assert len({r["text"] for r in out if r["n_entities"] == 3 and r["text"].startswith("Write")}) == 1


def test_names_keep_gender_script_and_coreference(replaced):
    _, by = replaced
    a, b, c, *_ = by[3]["surrogates"].split(" | ")
    assert a.split()[0] == "Mrs." and b.split()[0] == "Mr." and a.split()[2] == b.split()[2] == c.split()[1]
    assert any(a.split()[1].endswith(e) for e in surrogates.ENDINGS["latin"]["f"])
    assert any(b.split()[1].endswith(e) for e in surrogates.ENDINGS["latin"]["m"])
    ivan = by[4]["surrogates"].split(" | ")[0].split()
    assert ivan[0] == "господин" and all("а" <= x.lower() <= "я" for x in ivan[1] + ivan[2])
    assert by[3]["surrogates"].split(" | ")[-1].split()[-1].isupper()


def test_collisions_are_drawn_again(spark):
    # four-digit endings leave few draws, and some draws equal real values
    values = [("social", f"{i:03d}-45-6789") for i in range(200)] + [("ip", f"240.0.{i}.1") for i in range(200)]
    df = spark.createDataFrame(values, "kind string, value string")
    rows = surrogates.assign(df).collect()
    got = [r["surrogate"] for r in rows]
    assert len(got) == len(set(got)) == len(values) and not set(got) & {v for _, v in values}
    many = spark.range(3000).selectExpr("'first f' AS kind", "concat('N', id) AS value")
    rows = surrogates.assign(many).collect()
    assert len({r["surrogate"] for r in rows}) == 3000
    assert sorted(map(tuple, rows)) == sorted(map(tuple, surrogates.assign(many.repartition(7)).collect()))


def test_addresses_are_found_whole(spark):
    rows = [(1, "From 192.168.100.123 and 192.168.100.124, 96.153.118.61."), (2, "Port 22 192.168.100.123 up"),
            (3, "Call +49 192.168.100.123"), (4, "Lost...192.168.100.123."), (5, "Call 202.555.0123 or 1.202.555.0123"),
            (6, "Call 555-123-4567.2 days later")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    by = {r["doc_id"]: r for r in surrogates.pseudonymise(df).collect()}
    a, b, c = by[1]["surrogates"].split(" | ")
    assert len({a, b, c}) == 3
    for ip in (a, b, c):
        octets = [int(o) for o in ip.split(".")]
        assert len(octets) == 4 and 240 <= octets[0] <= 254 and max(octets) <= 255
    assert by[1]["text"] == f"From {a} and {b}, {c}."
    assert by[2]["text"] == f"Port 22 {a} up"
    assert by[3]["text"] == f"Call +49 {a}" and by[4]["text"] == f"Lost...{a}."
    assert by[5]["n_entities"] == 2 and by[6]["n_entities"] == 1


def test_keys_of_either_case(spark):
    keys = ["9a3f0c0b" * 4, "9A3F0C0B" * 4, "AB12CD34" * 4, "9a3F0c0B" * 5, "1234567890" * 4]
    df = spark.createDataFrame([(i, f"KEY {k}.") for i, k in enumerate(keys)], "doc_id bigint, text string")
    by = {r["doc_id"]: r for r in surrogates.pseudonymise(df).collect()}
    made = [by[i]["surrogates"] for i in range(5)]
    for i, (key, new) in enumerate(zip(keys, made)):
        assert by[i]["text"] == f"KEY {new}." and new != key and len(new) == len(key)
        int(new, 16)
    assert made[0] == made[0].lower() and made[1] == made[1].upper() and made[2] == made[2].upper()
    assert all(n.isdigit() or n.isupper() == c.isupper() for n, c in zip(made[3], keys[3]))


def test_no_documents(spark):
    assert surrogates.pseudonymise(spark.createDataFrame([], DOCS)).count() == 0


def distance(item, doc):
    """Edits between all of `item` and the best substring of `doc`."""
    row = [0] * (len(doc) + 1)
    for i, c in enumerate(item, 1):
        before, row[0] = row[0], i
        for j, d in enumerate(doc, 1):
            before, row[j] = row[j], min(before + (c != d), row[j] + 1, row[j - 1] + 1)
    return min(row)


def plain(text):
    return "".join(map(chr, decontaminate.normalise(text)[0]))


def test_passages_within_the_budget_are_found():
    rng = random.Random(12)
    letters = "abcdefghijklmnopqrst"
    items = [(i, " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(rng.randrange(6, 30))))
             for i in range(12)]
    index = decontaminate.Index.build(items + [(90, ""), (91, "short")], decontaminate.Q, decontaminate.RATE)
    for trial in range(150):
        i, item = items[trial % 12]
        chars = list(item)
        for _ in range(rng.randrange(0, len(chars) // 7)):
            at = rng.randrange(len(chars))
            chars[at:at + 1] = rng.choice([[], ["z"], [chars[at], "z"]])
        before = "".join(rng.choice(letters + " ") for _ in range(rng.randrange(200)))
        doc = before + " " + "".join(chars).title() + "\n" + before[::-1]
        code, budget = plain(item), index.edits[[k for k, _ in items].index(i)]
        edits = distance(code, plain(doc))
        got = {h[0]: h for h in index.find(doc)}
        assert (i in got) == (edits <= budget), (trial, edits, budget)
        if i in got:
            assert got[i][3] == edits
            assert abs(got[i][1] - len(before) - 1) <= 2 * budget + 2


def test_stored_matches_and_clean_rows(spark):
    rng = random.Random(13)
    passage = " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(20))
    bench = spark.createDataFrame([(1, passage), (1, passage), (2, None), (None, passage[::-1]), (3, "")],
                                  "item_id bigint, text string")
    rows = [(1, passage, "en", "s", 1), (2, None, None, None, None), (3, "", "en", "s", 1), (None, "x " + passage, "en", "s", 1),
            (4, words(rng, 300), "en", "s", 1), (5, words(rng, 60000) + passage.upper() + ".", "en", "s", 1)]
    df = spark.createDataFrame(clashing(rows + rows[:1]), DOCS + CLASH)
    for size in (decontaminate.BLOCK_CHARS, 50):
        found = decontaminate.matches(df, bench, block_chars=size).collect()
        assert sorted((r["doc_id"] or -1, r["item_id"]) for r in found) == [
            (-1, 1), (-1, 1), (1, 1), (1, 1), (1, 1), (1, 1), (5, 1), (5, 1)]
        kept = decontaminate.clean(df, bench, block_chars=size)
        assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4]
    assert decontaminate.clean(df, bench.limit(0)).count() == 7
    assert decontaminate.matches(df.limit(0), bench).count() == 0


def test_long_documents_are_sliced(monkeypatch):
    rng = random.Random(14)
    passage = words(rng, 40, 10_000)
    index = decontaminate.Index.build([(1, passage)], decontaminate.Q, decontaminate.RATE)
    monkeypatch.setattr(decontaminate, "SLICE", 300)
    for gap in range(0, 900, 60):
        doc = words(rng, gap + 1, 10_000) + " " + passage + " " + words(rng, 300, 10_000)
        assert [h[3] for h in index.find(doc)] == [0]


PIECES = st.lists(st.sampled_from(["<|im_start|>", "<|im_end|>", "\n", "<|", "|>", "<", "|", "\\", "<\\|", "<\\\\|",
                                   "assistant", "ok", " ", "ä", "😀", "user\n"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(PIECES, PIECES), max_size=4), st.integers(1, 7))
def test_any_turns_come_back(turns, step):
    text = "".join(chat.render_turn(r, t) for r, t in turns)
    assert chat.parse(text) == turns
    parser, got = chat.Parser(), []
    for i in range(0, len(text), step):
        got += parser.feed(text[i:i + step])
    parser.close()
    assert got == turns


def test_plain_turns_are_not_escaped():
    assert chat.render_turn("user", "a\n b \\ < | >") == "<|im_start|>user\na\n b \\ < | ><|im_end|>\n"


def test_conversations_with_nulls(spark):
    import hashlib
    rows = [(1, 2, "assistant", "two"), (1, 1, "user", None), (1, 3, "assistant", chat.PROBE), (1, 3, None, "x"),
            (None, 1, "assistant", "z"), (2, None, "user", "first"), (2, 0, "user", "second"), (2, 0, "user", "second")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r["conv_id"]: r for r in chat.read_back(chat.render(df)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1]["turns_sha256"] == sha(f"user\n\nassistant\ntwo\n\nx\nassistant\n{chat.PROBE}\n")
    assert got[1]["loss_sha256"] == sha("two" + chat.PROBE) and got[1]["n_turns"] == 4
    assert got[2]["turns_sha256"] == sha("user\nfirst\nuser\nsecond\nuser\nsecond\n") and got[2]["loss_chars"] == 0
    assert got[None]["n_turns"] == 1
    assert chat.read_back(chat.render(df.limit(0))).count() == 0
    with pytest.raises(chat.Malformed):
        chat.parse("<|im_start|>user\nx")
    assert np.all([k in got for k in (1, 2, None)])
