"""Surrogates, quotation linking and mixing."""

import re

import pytest

from articlelake.llm import mixing, quotes, surrogates

TEXTS = [
    (1, "Mail a.Bc12@Mail7.example.com or A.BC12@mail7.example.com, call +1 (609) 555-2028 or 609-555-2028."),
    (2, "ip 56.187.231.175 card 4111-1111-1111-1111 and 4111111111111111, ssn 123-45-6789; 56.187.231.175"),
    (3, '"59b79a44c83160ff605db5295c3f1b8f59a30bf7" 59B79A44C83160FF605DB5295C3F1B8F59A30BF7'),
    (4, "Mr. John Smith met Mrs. Anna SMITH and Mr. Smith; г-жа Иванова"),
    (5, None),
    (6, ""),
    (7, "nothing 3.4.0. here 1.2.3.4.5 and 12-34"),
    (None, "x reê.10@mail2.example.com###"),
    (None, None),
    (8, "a.bc12@mail7.example.com"),
    (8, "a.bc12@mail7.example.com"),
]


def test_surrogates(spark, none, odd):
    table = spark.createDataFrame(TEXTS, "doc_id long, text string").selectExpr("doc_id", "text", "1 AS at", "2 AS hash")
    rows = surrogates.replace_entities(table).collect()
    assert len(rows) == len(TEXTS)
    got = {r["doc_id"]: r["text"] for r in rows if r["doc_id"] is not None}
    one, other = re.findall(r"\S+@\S+\.com", got[1])
    assert one.lower() == other.lower() == got[8] and one[0].islower() and one[2].isupper()
    with_code, without = re.search(r"\+1 \((\d{3})\) (\d{3})-(\d{4}) or (\d{3}-\d{3}-\d{4})", got[1]).groups()[:3], got[1][-13:-1]
    assert "-".join(with_code) == without != "609-555-2028"
    ips = re.findall(r"\d+\.\d+\.\d+\.\d+", got[2])
    cards = re.findall(r"4[\d-]{15,}", got[2])
    assert len(set(ips)) == 1 and ips[0] != "56.187.231.175" and cards[0].replace("-", "") == cards[1]
    digits = [int(d) for d in cards[1]][::-1]
    assert (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0
    a, b = re.findall(r"[0-9A-Fa-f]{40}", got[3])
    assert a.upper() == b
    name = re.fullmatch(r"Mr\. (\w+) (\w+) met Mrs\. (\w+) (\w+) and Mr\. (\w+); г-жа (\w+)", got[4]).groups()
    assert name[1] == name[4] and name[3] == name[1].upper() and name[0].lower() in surrogates.GIVEN["given_m"].split()
    assert name[2].lower() in surrogates.GIVEN["given_f"].split() and re.fullmatch(r"[А-Яа-я]+", name[5])
    assert got[5] is None and got[6] == "" and got[7] == TEXTS[6][1]
    assert surrogates.replace_entities(none).isEmpty() and surrogates.replace_entities(odd).count() == odd.count()


def test_surrogates_stay_distinct(spark):
    """So many entities of few forms that they draw the same surrogates and each other's values."""
    entities = spark.range(4000).selectExpr("'email' AS kind", "concat(conv(id % 1000, 10, 36), '@', 'x.com') AS entity").distinct()
    drawn = surrogates.draw_surrogates(entities.filter("length(entity) <= 7"), "k").collect()
    assert len({r["surrogate"] for r in drawn}) == len(drawn) == entities.filter("length(entity) <= 7").count()
    assert not {r["surrogate"] for r in drawn} & {r["entity"].replace("@", "").replace(".com", "") for r in drawn}


def test_surrogates_reach_the_end_of_mentions(spark):
    """Whole mentions of any form, and untitled ones of people known by a title."""
    labels = ".".join(f"l{k}x" for k in range(30))
    texts = [
        "Mrs. Ana Maria Lopez Garcia's car. Then Garcia and ANA left, Garcian not.",
        "Dear Mr. J. Smith and Herr von Berg, also Mr. J.R.R. Tolkien; Dear J.R.R. Tolkien",
        "So Mr. John Smith came. Later John Smith spoke, Smith left. The Mr. Smith, Mail John.smith@x.com See Berg",
        "See Ana Maria Lopez Garcia there, and Old John Smith; Smith alone",
        "+33 06 12 34 56 78, +33 1 23 45 67 89, +32 2 555 12 12, 555 123 4567, +1 (609) 555-2028.",
        f"a@{labels}.com, b@x.com-thanks, c@mail7.example.museum. d@x.com.5 e@1.2.abcdefghijklmnopqrstuvwxyzabc",
        "f" * 40 + "0a" * 44 + " " + "Mr. Παπαδόπουλος",
    ]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in surrogates.replace_entities(table).collect()}
    got = [rows[k]["text"] for k in range(len(texts))]
    w = r"(\w+)"
    ana = re.fullmatch(rf"Mrs\. {w} {w} {w} {w}'s car\. Then {w} and {w} left, Garcian not\.", got[0]).groups()
    assert ana[3] == ana[4] and ana[5] == ana[0].upper() and not set(ana) & {"Ana", "Maria", "Lopez", "Garcia", "ANA"}
    j, smith, berg, jrr, tolkien = re.fullmatch(rf"Dear Mr\. (\w\.) {w} and Herr von {w}, also Mr\. (\w\.\w\.\w\.) {w}; Dear \4 \5", got[1]).groups()
    assert j != "J." and berg != "Berg" and tolkien != "Tolkien" and jrr[2] == jrr[4] != "R" and jrr[0] != jrr[2]
    john = re.fullmatch(rf"So Mr\. {w} {smith} came\. Later \1 {smith} spoke, {smith} left\. The Mr\. {smith}, Mail (\S+)@(\w)\.com See Berg", got[2])
    assert john[1] != "John" and john[2].lower() != "john.smith" and rows[2]["n_entities"] == 5
    assert got[3] == f"See {' '.join(ana[:4])} there, and Old {john[1]} {smith}; {smith} alone"
    digits = lambda t: re.findall(r"\d", t)
    assert re.sub(r"\d", "0", got[4]) == re.sub(r"\d", "0", texts[4]) and got[4].startswith("+33 ")
    assert sum(a == b for a, b in zip(digits(got[4]), digits(texts[4]), strict=True)) < 20 and rows[4]["n_entities"] == 5
    assert not any(part in got[4] for part in ("34 56 78", "67 89", "12 12", "123 4567"))
    assert not re.search(r"l\d+x|mail7|example", got[5]) and "-thanks" in got[5] and ".museum. " in got[5] and rows[5]["n_entities"] == 5
    assert re.fullmatch(r"[0-9a-f]{128} Mr\. \w+", got[6]) and not got[6].startswith("f" * 40)


def test_people_of_one_surname_stay_distinct(spark):
    """More given names than the lists hold, some of them of the lists, in three scripts."""
    names = [*surrogates.GIVEN["given_m"].split(), *(f"ab{chr(97 + k)}" for k in range(20))]
    greek = ["Νίκος", "Γιώργος", "Αχιλλέας"]
    texts = [f"Mr. {n.title()} Smith" for n in names] + [f"Mrs. {n.title()} Smith" for n in names[:5]]
    texts += [f"Mr. {n} Παπαδόπουλος" for n in greek]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in surrogates.replace_entities(table).collect()}
    assert len(set(got.values())) == len(texts) and not set(got.values()) & set(texts)
    assert not {t.split()[1].lower() for t in got.values()} & set(names)
    assert len({got[k].split()[-1] for k in range(len(names) + 5)}) == 1
    assert all(re.fullmatch(r"Mr\. [\u0370-\u03ff]+ [\u0370-\u03ff]+", got[k]) for k in range(len(texts) - 3, len(texts)))
    assert not {n.split()[1] for n in list(got.values())[-3:]} & set(greek)


def test_full_forms_grow(spark):
    """All addresses of one form occur, so their surrogates need another one."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    mails = [f"{a}@{b}.{end}" for a in letters for b in letters for end in ("co", "de")]
    table = spark.createDataFrame([(i, f"to {m} now") for i, m in enumerate(mails)], "doc_id long, text string")
    got = surrogates.replace_entities(table).collect()
    new = {r["doc_id"]: r["text"].split()[1] for r in got}
    assert len(set(new.values())) == len(mails) and not set(new.values()) & set(mails)
    assert all(new[i].count("@") == 1 and new[i].split(".")[-1] == m.split(".")[-1] for i, m in enumerate(mails))


def test_quotes(spark):
    rows = [
        (1, 0, "u", "Hello there\nhow are you?"),
        (1, 1, "a", "> hello   THERE\nFine."),
        (1, 2, "u", "New topic here"),
        (1, 3, "u", ">> Hello there\n> Fine.\nGood\n> never said"),
        (1, 4, "u", "> New topic\n> here\nyes"),
        (1, None, "u", "> New topic here"),
        (2, 0, "u", None),
        (2, 1, "u", ""),
        (2, 2, None, ">"),
        (None, 5, "u", "a"),
        (None, 6, "u", ">a\nb"),
        (3, 0, "u", "x"),
        (3, 0, "u", "x"),
        (3, 1, "u", "> x\nok"),
        (4, 0, "u", ">" * 2000 + "deep\n" + " " * 100_000),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS hash", "2 AS depth")
    got = {(r["conv_id"], r["position"]): r for r in quotes.reply_order(table).collect()}
    assert len(got) == len(rows)
    first = [got[(1, k)] for k in range(6)]
    assert [(r["turn"], r["reply_to"], r["thread"], r["depth"]) for r in first] == [
        (0, None, 0, 0), (1, 0, 0, 1), (3, 1, 0, 2), (2, None, 2, 0), (4, 2, 2, 1), (None, None, None, 0),
    ]
    assert [r["body"] for r in first] == [rows[0][3], "Fine.", "Good\n> never said", rows[2][3], "yes", rows[5][3]]
    assert (got[(None, 1)]["reply_to"], got[(None, 1)]["body"]) == (5, "b")
    assert (got[(3, 2)]["reply_to"], got[(2, 0)]["body"], got[(2, 2)]["body"]) == (0, None, ">")
    assert quotes.reply_order(table.limit(0)).isEmpty()


def test_only_found_lines_go(spark):
    rows = [
        (1, 0, "u", "Thanks"), (1, 1, "a", "> never said one\n> two\n> three\n> Thanks\nreply body"),
        (1, 2, "u", "alpha\nbeta"), (1, 3, "a", "> beta\n>\n> alpha\nyes\n> Thanks\n> alpha\n> other"),
    ]
    got = {r["turn"]: r for r in quotes.reply_order(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got[1]["body"] == "> never said one\n> two\n> three\nreply body" and got[1]["reply_to"] == 0
    assert got[3]["body"] == "yes\n> other" and got[3]["reply_to"] == 2 and got[3]["n_linked"] == 2
    # Against a plain version: every line that stays stood in the text, in its order.
    for r, (_, turn, _, text) in zip(sorted(got.values(), key=lambda r: r["turn"]), rows, strict=True):
        lines = iter(text.split("\n"))
        assert r["turn"] == turn and all(line in lines for line in r["body"].split("\n"))


def test_long_reply_chain(spark):
    rows = [(1, k, "u", (f"> line number {k - 1}\n" if k else "") + f"line number {k}") for k in range(60)]
    got = quotes.reply_order(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {r["turn"]: (r["thread"], r["depth"]) for r in got} == {k: (0, k) for k in range(60)}


@pytest.mark.parametrize("block", [7, 2048])
def test_mix(odd, odd_rows, none, block):
    plan = mixing.mix(odd, block_words=block)
    rows = plan.documents().collect()
    assert len(rows) == len(odd_rows)
    sizes, takes = {}, {}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["target"] <= 2 * r["source_size"]
        sizes.setdefault((r["source_size"], r["target"]), []).append(r["size"])
        takes.setdefault((r["source_size"], r["target"]), []).append(r["taken"])
    for (size, target), own in takes.items():
        assert sum(sizes[(size, target)]) % max(size, 1) == 0 and abs(sum(own) - target * sum(sizes[(size, target)]) / max(size, 1)) <= 2
    total = sum(r["size"] for r in rows)
    assert abs(sum(r["taken"] for r in rows) - 1.5 * total) <= 4
    again = mixing.mix(odd.repartition(2), block_words=block).documents().collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    assert mixing.mix(none).documents().isEmpty()


def test_schedule_follows_targets_throughout(docs):
    plan = mixing.mix(docs, block_words=50)
    slots = [r["sid"] for r in plan.schedule.orderBy("slot").collect()]
    goals = {r["sid"]: r["target"] for r in plan.sources.collect()}
    whole = sum(goals.values())
    for upto in (len(slots) // 4, len(slots) // 2):
        for sid, goal in goals.items():
            assert abs(slots[:upto].count(sid) - upto * goal / whole) <= 4


def test_mixed_rows(odd, docs):
    assert mixing.mixed_rows(odd).columns == odd.columns
    words = mixing.mix(docs)
    got = {r["doc_id"]: r["count"] for r in mixing.mixed_rows(docs).groupBy("doc_id").count().collect()}
    for r in words.documents().collect():
        assert got.get(r["doc_id"], 0) == -(-r["taken"] // r["size"]) if r["size"] else r["doc_id"] not in got
