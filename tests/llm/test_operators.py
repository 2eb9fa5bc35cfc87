"""The corpus operators against plain answers: nulls, empty and long texts, ties, repeated rows, empty tables, extra columns."""

import hashlib
import itertools
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagequarry.llm import (
    bpe,
    components,
    fingerprint,
    jaccard_join,
    langid,
    line_dedup,
    mixing,
    surrogates,
    token_trees,
    url_filter,
    vector_graph,
)

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, n_tokens string, component_id string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed, n):
    rng = np.random.default_rng(seed)
    syllables = "ba ne ti lo ru ma se di ko fu".split()
    return " ".join("".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    base = prose(1, 200)
    near = base.split(" ")
    near[100] = "changed"
    odd = [None, "", "  \t ", "one two", "One TWO", base, base, " ".join(near), "a" * 5_000, "x<|endoftext|>y  'll ½ é漢\r\n", prose(2, 3_000)]
    return odd + [prose(i, 40) for i in range(10, 16)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, "n", "c") for i, t in enumerate(texts)] + [(None, "one two", "n", "c")], DOCS)


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def test_tokens_are_those_of_the_library(docs, library):
    found = bpe.decode(bpe.encode(docs, PATH), PATH)
    for row in found.collect():
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["ids"] == ids
        assert row["decoded"] == library.decode(ids, skip_special_tokens=False) == (row["text"] or "")
    short = bpe.round_trip(docs, PATH, outputs=(), keep_text=False)
    assert "text" not in short.columns and short.where("doc_id = 1").first()["n_tokens"] == 0
    assert bpe.encode(docs.limit(0), PATH).count() == 0


def test_pre_tokens_of_every_character_are_those_of_the_library(library):
    mine = bpe.Tokenizer(bpe.read_spec(PATH))
    letters, numbers = bpe.character_classes()
    kinds = [letters[c] + 2 * numbers[c] for c in range(0x110000)]
    edges = {c + d for c in range(1, 0x110000) if kinds[c] != kinds[c - 1] for d in (-1, 0)}
    texts = [f"a{chr(c)} {chr(c)}{chr(c)}b 1{chr(c)}'s" for c in sorted({*range(0x3000), *edges}) if not 0xD800 <= c < 0xE000]
    for text, right in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(mine.encode(text), dtype="<u4").tolist() == right.ids


def test_edits_count_as_a_new_text_would(library):
    coder = bpe.Tokenizer(bpe.read_spec(PATH))
    rng = np.random.default_rng(3)
    bits = ["a", "  ", "<|end", "oftext|>", "'l", "é", "\n", "12", "word", " x"]
    for _ in range(150):
        text = "".join(rng.choice(bits, rng.integers(0, 300)))
        tree = token_trees.build_tree(text, coder)
        for _ in range(3):
            start, removed = rng.integers(0, len(text) + 2), rng.integers(0, 20)
            text, _ = token_trees.apply_edit(text, tree, coder, int(start), int(removed), "".join(rng.choice(bits, rng.integers(0, 6))))
            assert tree.total == (len(text), len(library.encode(text, add_special_tokens=False).ids))


def test_small_edits_of_long_texts_read_little(spark):
    text = prose(4, 20_000)
    docs = spark.createDataFrame([(1, text, [(500, 3, "new ")]), (2, None, None)], f"doc_id long, text string, edits {token_trees.EDITS}")
    rows = {r["doc_id"]: r for r in token_trees.count_with_edits(docs, PATH).collect()}
    assert rows[1]["encoded_again"] < 2_000 and rows[1]["edited"] == text[:500] + "new " + text[503:]
    assert (rows[2]["n_tokens"], rows[2]["n_tokens_edited"]) == (0, 0)


def test_languages_are_told_apart_and_the_undecidable_is_refused(spark):
    rng = np.random.default_rng(5)
    words = {"aa": "bana nena tola".split() + [prose(i, 1) for i in range(200)], "zz": [w[::-1] + "x" for w in (prose(i, 1) for i in range(200))]}
    rows = [(i, " ".join(rng.choice(words[lang], 60)), lang) for i, lang in enumerate(["aa", "zz"] * 60)]
    rows += [(900, None, "aa"), (901, "12 !", "zz"), (902, "banana", None), (None, "tola", "aa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert [name for name, _ in model.samples] == ["aa", "zz"]
    found = {r["doc_id"]: r for r in langid.identify(docs, model).withColumn("out", langid.held_out()).collect()}
    assert all(found[i]["lang_pred"] == lang for i, _, lang in rows[:120] if found[i]["out"])
    assert (found[900]["lang_pred"], found[901]["lang_pred"], found[901]["accepted"]) == ("und", "und", False)
    assert langid.identify(docs, langid.fit(docs.limit(0))).first()["lang_pred"] == "und"


def test_numbers_are_no_letters_and_marks_belong_to_words():
    for text in ("½", "² ³", "Ⅷ", "12 !", "٣", "①", "\u0301", "_", "", "日"[:0]):
        assert langid.letters(text) == ""
    assert langid.letters("नमस्ते दुनिया!") == "नमस्ते दुनिया"
    assert langid.letters("Été 2x² ab_c") == "été x ab c"
    assert langid.classify("½", langid.Model((("aa", b"some words"),))) == ("und", 0.0)


def test_sources_meet_their_targets(spark):
    rows = [(i, f"s{i % 4}" if i % 4 else None, prose(i, 5 + i % 30)) for i in range(400)] + [(7, "s3", None), (8, "empty", "")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    planned = mixing.plan_mix(docs).collect()
    by: dict = {}
    for r in planned:
        assert r["size"] == len(WORD.findall(r["text"] or "")) and 0 <= r["copies"] <= 3
        total, taken, target = by.get(r["source"], (0, 0, 0))
        by[r["source"]] = (total + r["size"], taken + r["size"] * r["copies"], r["target"])
    everything = sum(t for t, _, _ in by.values())
    # weights in the order of the names: empty 5, s1 2, s2 1, s3 5, null 2; "empty" has nothing to give
    for source, weight in {"s1": 2, "s2": 1, "s3": 5, None: 2}.items():
        total, taken, target = by[source]
        assert target == pytest.approx(min(3 * total, everything * weight / 10))
        assert abs(taken - target) <= 40
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in planned)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_recurring_lines_go_and_others_stay(spark):
    log = [f"user {i} logged in from host h{i} today" for i in range(6)]
    general = [f"dear reader please note that {w} is closed for the season" for w in "alpha beta gamma delta epsilon".split()]
    rows = [(i, f"{prose(i, 12)}\n{log[i % 6]}\n\nshort\n{general[i % 5]}") for i in range(12)]
    rows += [(50, "the same copy of a text line"), (51, "the same copy of a text line"), (60, None), (61, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"]: r for r in line_dedup.drop_recurring_lines(docs).collect()}
    for i in range(12):
        assert kept[i]["text"] == f"{prose(i, 12)}\n\nshort" and kept[i]["n_dropped"] == 2
    assert kept[50]["n_dropped"] == 0 and kept[60]["text"] is None and (kept[61]["text"], kept[61]["n_lines"]) == ("", 1)


def test_lines_that_differ_in_the_fourth_or_fifth_word_are_one_template(spark):
    words = "alpha beta gamma delta epsilon".split()
    fourth, fifth = "please note that {} is closed for the season", "all guests of the {} are asked to wait"
    rows = [(i, f"{prose(i, 12)}\n{fourth.format(w)}\n{fifth.format(w)}") for i, w in enumerate(words)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for r in line_dedup.drop_recurring_lines(docs).collect():
        assert (r["text"], r["n_dropped"]) == (prose(r["doc_id"], 12), 2)


def test_short_lines_and_lines_without_spaces_recur_too(spark):
    same = ["Les.", "And ornd.", "本页内容仅供参考", "共有3个结果", "page {}"]
    rows = [(i, "\n".join([prose(i, 12), *same, f"{i}", f"{i} {i + 1}", f"第{i}章", "\u3000"]).format(i)) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for r in line_dedup.drop_recurring_lines(docs, min_words=1).collect():
        i = r["doc_id"]
        # numbers alone, numbered Chinese lines and blank lines are no copies of each other
        assert r["text"] == "\n".join([prose(i, 12), f"{i}", f"{i} {i + 1}", f"第{i}章", "\u3000"]) and r["n_dropped"] == len(same)


def brute_sets(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_groups(rows):
    sets = {i: brute_sets(t) for i, t in rows}
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(sets, 2):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]) and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return {i: (len(sets[i]), label[i]) for i in sets}


def test_groups_of_similar_documents_are_those_of_brute_force(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "PAIRS_AT_ONCE", 3)
    rng = np.random.default_rng(6)
    rows = [(0, None), (1, ""), (2, "a b"), (3, "A  b"), (4, "a b c d e")]
    passage = prose(99, 50)
    for k in range(12):
        words = prose(100 + k, int(rng.integers(5, 150))).split(" ") + passage.split(" ") * (k % 2)
        for _ in range(6):
            changed = list(words)
            for _ in range(int(rng.integers(0, max(2, len(words) // 25)))):
                changed[int(rng.integers(len(changed)))] = prose(int(rng.integers(1 << 30)), 1)
            rows.append((len(rows), " ".join(changed)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(docs).collect()}
    expected = brute_groups(rows)
    assert found == expected
    kept = jaccard_join.keep_one_per_group(docs.unionByName(docs.where("doc_id = 4")))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, (_, c) in expected.items() if i == c)


def test_keys_of_similar_sets_always_meet():
    rng = np.random.default_rng(7)
    nothing = jaccard_join.Guess(np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64))
    for size in (1, 4, 9, 30, 45, 60, 95, 96, 120, 300, 1_000):
        for _ in range(30):
            a = rng.integers(0, 1 << 63, size, dtype=np.uint64)
            cut = int(rng.integers(0, size // 9 + 1))
            b = np.unique(np.concatenate([a[cut:], rng.integers(0, 1 << 63, cut, dtype=np.uint64)]))
            a = np.unique(a)
            common = len(np.intersect1d(a, b))
            if 100 * common >= 80 * (len(a) + len(b) - common):
                keys = [set(jaccard_join.document_keys(jaccard_join.ShingleSet(x), nothing).tolist()) for x in (a, b)]
                assert keys[0] & keys[1]


def test_edited_texts_and_fingerprints(spark, texts):
    rows = [(i * 3, t) for i, t in enumerate(texts)] + [(None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in fingerprint.compare_with_next(docs).collect()}
    order = sorted((r for r in rows if r[0] is not None), reverse=True) + [(None, "no id")]
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        edited = text[: len(text) - len(text) // 3] + after[: len(text) // 3]
        assert (found[i]["n_chars"], found[i]["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert found[i]["fingerprint"] == fingerprint.as_text(fingerprint.chunk_set(text.encode()))
        assert 0 <= found[i]["near_next"] <= 1
    shifted = fingerprint.chunk_set(("inserted " + texts[10]).encode())
    assert fingerprint.containment(fingerprint.chunk_set(texts[10].encode()), shifted) > 0.9
    assert fingerprint.compare_with_next(docs.limit(0)).count() == 0


def test_urls_follow_rules_and_aliases(spark):
    canonical = '<LINK href="http://blocked.net/es/a" REL="canonical">'
    pages = [
        (1, "HTTP://WWW.Example.com/en/x?q#f", None),
        (2, "http://a.example.com/en/x", ""),
        (3, "http://q.org/es/", canonical),
        (4, "http://q.org/fr", '<meta http-equiv="refresh" content="0; url=http://q.org/es/#top">'),
        (5, "http://r.com", '<link rel="canonical" href="http://blocked.net/es/a">'),
        (6, None, canonical),
        (7, "nothing", canonical),
        (8, "http://s.com/ok", canonical.replace("/es/a", "/fr/b")),
        (9, "http://t.org/x", canonical.replace("/es/a", "/fr/b")),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("rule", F.lit("old"))
    found = {r["page_id"]: tuple(r)[2:] for r in url_filter.judge_urls(df, url_filter.rule_table(spark)).collect()}
    assert found[1] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert found[2] == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert found[3][2:] == (None, "block") and found[4][2:] == (None, "block") and found[5][2:] == (None, "block")
    assert found[6] == found[7] == ("", "", None, "allow")
    assert found[8][2:] == ("com/", "allow") and found[9][2:] == (None, "allow")  # an alias is allowed outright


def test_a_fragment_begins_behind_the_host(spark):
    pages = [(1, "x#y://foo.net/es/a", None), (2, "http://a.net#://b.com/es/", None), (3, "http://q.org/a?b#c", None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {r["page_id"]: tuple(r)[2:] for r in url_filter.judge_urls(df.withColumn("x", F.lit(1)), url_filter.rule_table(spark)).drop("x").collect()}
    assert found[1] == ("foo.net", "/es/a", "net/es/", "block")
    assert found[2] == ("a.net", "", None, "allow") and found[3] == ("q.org", "/a", None, "allow")


def test_links_of_a_page_full_of_open_tags_are_found_at_once(spark):
    begun = time.monotonic()
    html = "<link " * 200_000 + '<link rel="canonical" href="http://b.net/es/">' + "<meta " * 200_000
    df = spark.createDataFrame([(1, "http://q.org/", html)], "page_id long, url string, html string")
    assert [r.target for r in url_filter.page_links(df).collect()] == ["http://b.net/es/"]
    assert time.monotonic() - begun < 20


def test_aliases_may_differ_in_the_case_of_scheme_and_host(spark):
    blocked = '<link rel="canonical" href="http://blocked.net/es/a">'
    pages = [
        (1, "HTTP://WWW.Q.org/Ab#x", blocked),
        (2, "http://r.org/x", '<link rel="canonical" href="http://www.q.org/Ab">'),
        (3, "http://www.Q.org/Ab", None),
        (4, "http://www.q.org/ab", None),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(df, url_filter.rule_table(spark)).collect()}
    assert found == {1: "block", 2: "block", 3: "block", 4: "allow"}


def test_chains_and_stars_are_one_component(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(5, 5), (None, 3), (200, 201), (201, 200)]
    found = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 160), 100), 200: 200, 201: 200}


def test_vectors_link_as_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vector_graph, "SHARD_ROWS", 120)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 16))
    dense = x[0] + 0.1 * rng.normal(size=(150, 16))
    vectors = np.concatenate([x, dense, x[5:8]])
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    odd = [(1_000, None), (1_001, [0.0] * 16), (1_002, [float("nan")] * 16), (1_003, [None, 1.0]), (1_004, [1.0, 2.0]), (1_005, [])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    found = {r["vec_id"]: r for r in vector_graph.near_duplicates(df).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.95) & ~np.eye(len(vectors), dtype=bool)
    got = np.array([found[i]["n_links"] for i in range(len(vectors))])
    assert (got <= links.sum(1)).all() and got.sum() >= 0.98 * links.sum()
    assert all(found[i]["n_links"] == 0 and found[i]["kept"] for i, _ in odd)
    assert found[305 + 145]["component_id"] == 5


def test_vectors_of_any_length_link_by_direction(spark):
    vectors = [[1e200, 0.0], [2e200, 0.0], [1e-200, 0.0], [1.0, 0.0], [3.0, 0.1], [0.0, 5e-324], [0.0, 1e308], [-1.0, 0.0]]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vector_graph.near_duplicates(df).collect()}
    assert found == {**{i: (4, 0) for i in range(5)}, 5: (1, 5), 6: (1, 5), 7: (0, 7)}


def test_surrogates_are_consistent_and_distinct(spark):
    lines = ["mail a.b@x.org or A.B@X.ORG", "call +1 (017) 555-7713 or +10175557713", "Mrs Anna Blum met Mr Otto Blum", "card 4111 1111 1111 1111", "at 10.0.0.1", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', "clean text, 12 words."]
    rows = [(i, t) for i, t in enumerate(lines)] + [(20, None), (21, ""), (22, lines[1])]
    found = {r["doc_id"]: r for r in surrogates.pseudonymize(spark.createDataFrame(rows, "doc_id long, text string"), b"k").collect()}
    first, second = re.findall(r"\S+@\S+", found[0]["text"])
    assert first.lower() == second.lower() != "a.b@x.org" and second.isupper()
    a, b = re.findall(r"\+[\d ()-]+\d", found[1]["text"])
    assert re.sub(r"\D", "", a) == re.sub(r"\D", "", b) != "10175557713" and a[:4] == "+1 ("
    assert re.fullmatch(r"Mrs [A-Z]\w+ [A-Z]\w+ met Mr [A-Z]\w+ [A-Z]\w+", found[2]["text"]) and "Blum" not in found[2]["text"]
    card = re.search(r"(\d{4} ){3}\d{4}", found[3]["text"]).group().replace(" ", "")
    assert surrogates._check_digit(card[:-1]) == int(card[-1])
    assert found[6]["text"] == lines[6] and found[20]["text"] is None and found[22]["text"] == found[1]["text"]
    new = {surrogates.surrogate("id", f"{n:09d}", b"k") for n in range(3_000)}
    assert len(new) == 3_000


def test_numbers_in_long_rows_are_all_found():
    lists = {
        "card": [f"4111 1111 1111 {n}" for n in range(1111, 1151)],
        "phone": [f"+49 30 1234 {n}" for n in range(5678, 5718)],
        "ip": [f"10.0.0.{n}" for n in range(40)],
        "id": [f"123-45-{n}" for n in range(6789, 6829)],
    }
    for kind, numbers in lists.items():
        for gap in (" ", "  ", " - ", ". "):
            text = gap.join(numbers)
            found = surrogates.find_entities(text)
            assert [(text[a:b], k) for a, b, k, _ in found] == [(n, kind) for n in numbers]
    for rule in ("+-" * 50_000, "(" * 100_000, "1 " * 50_000):
        assert surrogates.find_entities(rule) == []


def test_secrets_of_any_length_are_replaced_to_their_end():
    rng = np.random.default_rng(3)
    for n in (150, 200, 201, 300, 1_000, 20_000):
        body = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), n))
        for before, value in (("token=", f"eyJ{body}.{body}.{body}"), ("", "ghp_" + body), ("task-", "sk-" + body)):
            text, count = surrogates.replace_entities(f"see {before}{value} end", b"k", {})
            new = text.removeprefix(f"see {before}").removesuffix(" end")
            assert count == 1 and len(new) == len(value) and not any(value[i : i + 20] in new for i in range(len(value) - 19))
    a, b = "a1" * 400 + "x", "a1" * 400 + "z"
    new = [surrogates.surrogate("secret", value, b"k") for value in (a, b)]
    assert new[0] != new[1] and new[0][:200] != new[1][:200]
    # one-to-one: all texts that differ in one place of the last block
    assert len({surrogates.permute(b"k", "t", f"{'9' * 198}{i:04d}") for i in range(3_000)}) == 3_000


def test_colliding_surrogates_are_resolved(spark):
    names = [("person-f", f"anna {c}o") for c in "bcdfghjklmnpqrstvwxyz"] + [("person-f", f"{g} bo") for g in "ab ac ad ae af ag ah ai ak".split()]
    entities = spark.createDataFrame(names, "kind string, canonical string")
    attempts = {(r["kind"], r["canonical"]): r["attempt"] for r in surrogates.resolve_collisions(entities, b"k").collect()}
    new = [surrogates.surrogate(k, c, b"k", attempts.get((k, c), 0)) for k, c in names]
    assert len(set(new)) == len(names) and not set(new) & {c for _, c in names}


def test_only_chosen_texts_are_masked_again(spark, monkeypatch):
    """A line of each template is enough, so not all texts of a recurring leaf are read twice."""
    read = []
    masked_lines = line_dedup.masked_lines

    def counted(docs, *rest):
        read.append(docs.count())
        return masked_lines(docs, *rest)

    monkeypatch.setattr(line_dedup, "masked_lines", counted)
    colours = ["red", "blue"]
    docs = spark.createDataFrame([(i, f"{'x' * (i + 1)} own text alone\nposted in our group {colours[i % 2]} today again") for i in range(30)], "doc_id int, text string")
    kept = line_dedup.drop_recurring_lines(docs).collect()
    assert all(r.n_dropped == 1 and r.text.endswith("x own text alone") for r in kept)
    assert read[0] == 30 and 0 < read[1] < 30
