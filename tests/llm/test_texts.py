"""BPE, token counts, PII, quality rules, licences and URLs against plain Python."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from slotstream.llm import bpe, common, license_scan, pii, quality_rules, queries, token_counts, url_filter
from tests.compare import SF
from tests.llm.helpers import documents, prose, words

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
MODEL = bpe.ForcedBoundaryBpe(open(PATH, encoding="utf-8").read())
TEXTS = [None, "", " \n", "Hello, World! I'm don't 123", "Ça c'est ÉTÉ naïve ½ ²", "İstanbul Σας ﬁ 中文 テスト 🎉👩‍👩‍👧", "a<|endoftext|>B <|startoftext|>", "x" * 300, "\x1ca\x1fb\x85c d\x00e", "é å"]


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_bpe_agrees_with_the_library(spark):
    rows = bpe.decode(bpe.encode(documents(spark, TEXTS).withColumnRenamed("lang", "decoded"), PATH), PATH).orderBy("doc_id").collect()
    for row, text in zip(rows, TEXTS, strict=True):
        assert row.token_ids == library_ids(text)
        assert row.decoded == LIBRARY.decode(row.token_ids, skip_special_tokens=False)
    assert bpe.digests(documents(spark, TEXTS).limit(0), PATH).isEmpty()


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_bpe_of_any_text(text):
    assert np.frombuffer(MODEL.encode(text), dtype=np.int32).tolist() == library_ids(text)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abcdeqxzß'.!é", min_size=1, max_size=90))
def test_cuts_are_certain(word):
    """No token of the result spans a cut, and fragments merge alike alone, together and with a heap."""
    symbols, starts, first = MODEL.fragments([word, "x", word])
    assert first.tolist()[0] == 0 and len(first) == 3
    whole = symbols[: len(word.encode())].tolist()
    starts = starts[starts < len(whole)].tolist()
    assert not any(MODEL.joined[whole[s - 1], whole[s]] for s in starts[1:])
    parts = [whole[a:b] for a, b in zip(starts, [*starts[1:], len(whole)], strict=True)]
    merged = [s for p in parts for s in MODEL._merge_long(p)]
    assert merged == MODEL._merge_long(whole)
    assert [np.frombuffer(x, dtype=np.int32).tolist() for x in MODEL.words([word, "x", word])][::2] == [MODEL.ids[merged].tolist()] * 2


def test_bpe_with_little_memory(spark, monkeypatch):
    """Texts in small slices, and a memory that forgets all the time, give the same ids."""
    monkeypatch.setattr(bpe, "CACHE_BYTES", 2000)
    monkeypatch.setattr(bpe, "SLICE_CHARS", 20)
    model = bpe.ForcedBoundaryBpe(open(PATH, encoding="utf-8").read())
    texts = [*TEXTS, " ".join(f"wörd{i % 37} ÉTÉ<|endoftext|>{i}" for i in range(300)), "y" * 5000 + " z" * 50, "中文 " * 40]
    done = {}
    for row, ids in bpe._encoded(model, bpe.pa.array(texts)):
        done[row] = done.get(row, b"") + ids
    for i, text in enumerate(texts):
        assert np.frombuffer(done.get(i, b""), dtype=np.int32).tolist() == library_ids(text) == np.frombuffer(model.encode(text), dtype=np.int32).tolist()
    assert model.young_bytes < 20_000 and len(model.young) < 100
    lists = bpe.pa.array([[353, -1, 10**6], None, [], [354]], bpe.pa.list_(bpe.pa.int32()))
    assert model.decode(lists).to_pylist() == [LIBRARY.decode([353], skip_special_tokens=False), "", "", LIBRARY.decode([354], skip_special_tokens=False)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def digest_row(i, text):
    ids = library_ids(text)
    return i, len(ids), sha(" ".join(map(str, ids))), sha(LIBRARY.decode(ids, skip_special_tokens=False))


def test_bpe_digests(spark):
    texts = [*TEXTS, "tail " * 3000]
    assert sorted(map(tuple, bpe.digests(documents(spark, texts), PATH).collect())) == [digest_row(i, t) for i, t in enumerate(texts)]


def test_queries_of_encoded_lengths(spark):
    """op7 and op1 over the whole table against the library."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert sorted(map(tuple, queries.op7_bpe(spark, SF).collect())) == sorted(digest_row(r.doc_id, r.text) for r in docs)
    lengths = [len(library_ids(r.text)) for r in docs]
    rows = queries.op1_token_counts(spark, SF).collect()
    assert sorted(r.n_tokens for r in rows) == sorted(set(lengths))
    for r in rows:
        over = [n for n in lengths if n >= r.n_tokens]
        assert (r.n_docs, r.docs_from, r.tokens_from, r.total_docs, r.total_tokens, r.tokens_truncated) == (lengths.count(r.n_tokens), len(over), sum(over), len(lengths), sum(lengths), sum(min(n, r.n_tokens) for n in lengths))


@pytest.mark.parametrize("block", [3, 1024])
def test_token_counts(spark, monkeypatch, block):
    monkeypatch.setattr(token_counts, "BLOCK", block)
    lengths = [0, 0, 3, 5, 5, 9, 2000]
    sums = token_counts.suffix_sums(token_counts.length_histogram(spark.createDataFrame([(n,) for n in [*lengths, None]], "n int"), "n"))
    for r in sums.collect():
        over = [n for n in lengths if n >= r.n_tokens]
        assert (r.n_docs, r.docs_from, r.tokens_from, r.total_docs, r.total_tokens) == (lengths.count(r.n_tokens), len(over), sum(over), 7, sum(lengths))
        assert r.tokens_truncated == sum(min(n, r.n_tokens) for n in lengths)
    for limit in (0, 4, 5, 100, 10**6):
        assert tuple(token_counts.truncated_total(sums, limit).first()) == (sum(min(n, limit) for n in lengths), sum(n > limit for n in lengths))
    assert [token_counts.quantile_length(sums, q).first()[0] for q in (0.1, 0.5, 1.0)] == [0, 5, 2000]
    assert token_counts.suffix_sums(token_counts.length_histogram(spark.createDataFrame([], "n int"), "n")).isEmpty()


def test_pii(spark):
    texts = [
        "Mail und.34@mail7.example.com or UND.34@MAIL7.EXAMPLE.COM now", "call +1 (017) 555-7713, again +1-017-555-7713", "at 97.51.17.173 not 1.2.3 or 999.1.1.1",
        "cards 7536784127813050 4845168114407329 and 4111 1111 1111 1111", 'token = "04DBEBAB91AB85687D33EEAAF9AC699E1188F962" x', "Dear Mrs. Anna Keller and Mr. Иван Петров", "nothing here, v2.0 in 1999", None, "",
    ]
    rows = pii.replace_entities(documents(spark, texts).withColumnRenamed("lang", "n_replaced"), b"key").orderBy("doc_id").collect()
    out = [r.text for r in rows]
    assert [r.n_replaced for r in rows] == [2, 2, 1, 3, 1, 2, 0, 0, 0] and out[6:] == texts[6:]
    for old, new in zip(texts[:6], out[:6], strict=True):
        assert [k for k, *_ in pii.mentions(old)] == [k for k, *_ in pii.mentions(new)]
        for kind, a, b in pii.mentions(old):
            assert old[a:b] not in new, kind
    a, b = [out[0][x:y] for _, x, y in pii.mentions(out[0])]
    assert a.upper() == b and a != b and a.endswith("@mail7.example.com")
    c, d = [pii.canonical("phone", out[1][x:y]) for _, x, y in pii.mentions(out[1])]
    assert c == d
    assert pii._luhn(pii.canonical("card", [out[3][x:y] for _, x, y in pii.mentions(out[3])][2])) == 0
    assert out[4].split('"')[1].isupper() and len(out[4]) == len(texts[4])
    assert "Ѐ" <= out[5].rsplit(" ", 1)[1][1] <= "ӿ"


#: The expressions of op9 before texts were searched in pieces; the whole text is searched with them.
WHOLE_TEXT = pii.re.compile(pii._PATTERN.pattern.removeprefix(r"(?<![\w.%+-])"), pii.re.IGNORECASE)
ODD_PARTS = ["password", "API-KEY", "tokEn", "secret", ":", "=", "\n", "\n", " ", "\t", "\x85", "'", "correct-horse-battery", "abcdefabcdefabcdefabcdefabcdefab", "٤١١١ ١١١١ ١١١١ ١١١١", "+١ (٠١٧) ٥٥٥-٧٧١٣", "4111111111111111", "97.51.17.173", "MRs Keller", "mr. smith", "Señora Ruiz", ".foo@x.org", "a@b.example", "ſecretpaſſword", "K", "x", "-", "."]


def whole_text_mentions(text):
    m, found = WHOLE_TEXT.search(text), []
    while m:
        at = m.end()
        if m["title"]:
            end = pii._name_end(text, at) if m["title"][0].isupper() else at
            if list(pii._name_parts(text[at:end])):
                found.append(("f" if m["title"].lower() in [t.lower() for t in pii._FEMALE] else "m", at, end))
                at = end
        else:
            kind = m.lastgroup if m.lastgroup != "sep" else "card"
            a, b = m.span(kind)
            found.append(("hex" if kind == "secret" and pii.re.fullmatch("[0-9a-fA-F]{32,128}", text[a:b]) else kind, a, b))
        m = WHOLE_TEXT.search(text, at)
    return pii._with_untitled(text, found)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(ODD_PARTS), st.text(max_size=3)), max_size=12).map("".join))
def test_pii_search_in_pieces_finds_what_the_whole_text_holds(text):
    assert list(pii.mentions(text)) == list(whole_text_mentions(text))


@pytest.mark.parametrize(
    ("text", "kind", "found"),
    [("password:\n  correct-horse-battery", "secret", "correct-horse-battery"), ("api_key\n\n= \n'correct-horse-battery'", "secret", "correct-horse-battery"), ("card ٤١١١ ١١١١ ١١١١ ١١١١ x", "card", "٤١١١ ١١١١ ١١١١ ١١١١"),
     ("call +١ (٠١٧) ٥٥٥-٧٧١٣ x", "phone", "+١ (٠١٧) ٥٥٥-٧٧١٣"), ("key " + "abcdef" * 8, "hex", "abcdef" * 8), ("Dear MRs Keller", "f", "Keller"), ("token=abcdefghijkl.foo@x.org", "email", ".foo@x.org")],
)
def test_pii_of_several_lines_other_digits_and_letter_keys(text, kind, found):
    assert (kind, found) in [(k, text[a:b]) for k, a, b in pii.mentions(text)]
    assert found not in pii.replace(text, b"k", {})[0]


@pytest.mark.parametrize(
    ("text", "names"),
    [("Mr. Smith said so. Mr. Smith went.", ["Smith", "Smith"]), ("Mrs. Anna Maria Keller rose. Mrs. Keller sat; Keller and Anna Keller's dog.", ["Anna Maria Keller", "Keller", "Keller", "Anna Keller"]),
     ("Ms Smith-Jones met Mr. O'Brien and Jones, not Smithers.", ["Smith-Jones", "O'Brien", "Jones"]), ("Frau von der Leyen and Mr. J. R. Tolkien", ["von der Leyen", "J. R. Tolkien"]), ("MRS. KELLER, then Keller; write to Keller@x.org", ["KELLER"]), ("Mr. anna mail@x.org", [])],
)
def test_pii_whole_names(text, names):
    found = [(k, text[a:b]) for k, a, b in pii.mentions(text)]
    assert [x for k, x in found if k in ("f", "m")] == names
    new, n = pii.replace(text, b"k", {})
    assert n == len(found)
    after = [new[a:b] for k, a, b in pii.mentions(new) if k in ("f", "m")]
    parts = {}
    for old, got in zip(names, after, strict=True):
        for (a, b), (c, d) in zip(pii._name_parts(old), pii._name_parts(got), strict=True):
            assert parts.setdefault(old[a:b], got[c:d]) == got[c:d] != old[a:b]
    outside = lambda t, spans: "".join(t[e:s] for e, s in zip([0, *[b for _, _, b in spans]], [*[a for _, a, _ in spans], len(t)], strict=True))
    assert outside(text, pii.mentions(text)) == outside(new, pii.mentions(new))


def test_pii_accounts_addresses_and_numbers_with_checks():
    text = "Pay DE89 3704 0044 0532 0130 00 AND GB82WEST12345698765432, from 2001:DB8::1 or 2001:0db8:0:0:0:0:0:1, 078-05-1120. No: 12:30:45, std::dead::beef, 666-12-1234, XX00 3704 0044 0532"
    found = [(kind, text[a:b]) for kind, a, b in pii.mentions(text)]
    assert found == [("iban", "DE89 3704 0044 0532 0130 00"), ("iban", "GB82WEST12345698765432"), ("ipv6", "2001:DB8::1"), ("ipv6", "2001:0db8:0:0:0:0:0:1"), ("ssn", "078-05-1120")]
    new, n = pii.replace(text, b"key", {})
    assert n == 5 and new.endswith(text[text.index(". No:") :]) and not any(mention in new for _, mention in found)
    kinds, mentions = zip(*[(kind, new[a:b]) for kind, a, b in pii.mentions(new) if kind != "ipv6"], strict=True)
    assert kinds == ("iban", "iban", "ssn") and [len(m) for m in mentions] == [len(m) for k, m in found if k != "ipv6"]
    short, long = new[new.index("from ") + 5 :].split(",")[0].split(" or ")
    assert pii.canonical("ipv6", short) == pii.canonical("ipv6", long) and short.isupper() and len(short) == len("2001:DB8::1")
    for kind, canon in (("iban", "GB82WEST12345698765432"), ("ipv6", pii.canonical("ipv6", "fe80::1")), ("ssn", "078051120")):
        assert len({pii.surrogate(b"key", kind, canon, attempt) for attempt in range(40)}) > 20
        assert all(pii.canonical(kind, pii._render(kind, canon, drawn)) == drawn for drawn in (pii.surrogate(b"key", kind, canon, k) for k in range(7)))


def test_pii_phone_with_and_without_country_code():
    new, n = pii.replace("+1 (017) 555-7713 or (017) 555-7713 or +44 (017) 555-7713", b"k", {})
    a, b, c = new.split(" or ")
    assert n == 3 and a == f"+1 {b}" and b != "(017) 555-7713" and c.startswith("+44 ") and c[4:] != b


@pytest.mark.parametrize(
    ("text", "ordinary", "gone", "stays"),
    [("Frau Dr. Schmidt kam. Schmidt ging.", "", ["Schmidt"], "Frau Dr. * kam. * ging."), ("Dr. Helen Brown, Prof. Dr. med. Weber und Dr.-Ing. Kurz", "", ["Helen", "Brown", "Weber", "Kurz"], "Dr. * *, Prof. Dr. med. * und Dr.-Ing. *"),
     ("Mr Will May said: May we go? Will is fine, Will May too.", "may will", ["Will May"], "Mr * * said: May we go? Will is fine, * * too."), ("Mr President, the President said. Mr President Kern nods.", "", ["Kern"], "Mr President, the President said. Mr President * nods."),
     ("Herr Müller und die Müller GmbH, Mr. Bush and the Bush fire, Bush left Bush Street", "", ["Bush left"], "Herr * und die Müller GmbH, Mr. * and the Bush fire, * left Bush Street"), ("Mr. In The news", "", [], "Mr. In The news"),
     ("+49 30 1234567, 555-123-4567, +33 1 23 45 67 89", "", ["1234567", "555-123", "23 45"], None), ("write a.b@example.com", "", ["a.b@"], None)],
)
def test_pii_titles_ordinary_words_and_numbers(text, ordinary, gone, stays):
    ordinary = frozenset(ordinary.split())
    new, n = pii.replace(text, b"key", {}, ordinary)
    assert not any(x in new for x in gone) and len(new.split()) == len(text.split())
    if stays is not None:
        assert pii.re.fullmatch(pii.re.escape(stays).replace(r"\*", r"\w+"), new)
    elif "+" in text:
        assert new[:4] == "+49 " and new[17:21] != text[17:21] and "+33 " in new and n == 3
    else:
        assert all(x != y for x, y in zip(text[6:9:2], new[6:9:2], strict=True)) and new.endswith("@example.com")


def test_pii_one_family_name_has_one_surrogate():
    new, n = pii.replace("Mr John Smith, Mrs Anna Smith, Mr. Smith; John and Anna. Dr. Anna Kern", b"key", {})
    w = pii.re.findall(r"\w+", new)
    assert n == 6 and w[2] == w[5] == w[7] and w[1] == w[8] and w[4] == w[10] == w[12] and len({w[1], w[2], w[4], w[13]}) == 4
    assert w[1].endswith(("no", "rik", "mar")) and w[4].endswith(("na", "ria", "ela"))
    assert pii.replace("ask Mr J. Smith", b"key", {})[0] != "ask Mr J. Smith" and "J." not in pii.replace("ask Mr J. Smith", b"key", {})[0]


def test_pii_query_against_plain_replacement(spark, tmp_path):
    """The registered query: one surrogate an entity, none shared, nothing else changed, ordinary words told by the corpus."""
    plain = ["we will go and may stay; a rose, it will do " * 150, "the will of may", None, "", "x" * 200_000 + " a.b@x.org"]
    texts = [f"Mr Will May wrote {i % 7}{i % 7}@x.org on +49 30 {1000000 + i % 5}; May we? Will Keller go? Frau Dr. Rose Keller, Keller." for i in range(40)] + plain + ["Mr Will May wrote"] * 3
    table = documents(spark, texts)
    table.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op9_pii(spark, str(tmp_path)).collect()}
    ids = [r.doc_id for r in table.orderBy("doc_id").collect()]
    assert len(got) == len(texts)
    ordinary, forms, owners = frozenset({"will", "may", "rose"}), {}, {}
    for doc, old in zip(ids, texts, strict=True):
        new, found = got[doc].text, pii.mentions(old, ordinary)
        assert got[doc].n_replaced == len(found)
        if not found:
            assert new == old
            continue
        pattern = "".join(pii.re.escape(old[e:s]) + ("(.+?)" if s < len(old) else "") for e, s in zip([0, *[b for *_, b in found]], [*[a for _, a, _ in found], len(old)], strict=True)) if found[-1][2] < len(old) else None
        if pattern is None:
            assert new.startswith(old[: found[0][1]]) and old[found[0][1] :] not in new
            continue
        for (kind, a, b), drawn in zip(found, pii.re.fullmatch(pattern, new, pii.re.DOTALL).groups(), strict=True):
            old_words, new_words = (old[a:b].split(), drawn.split()) if kind in pii.NAMES else ([old[a:b]], [drawn])
            for x, y in zip(old_words, new_words, strict=True):
                assert forms.setdefault(x, y) == y != x and owners.setdefault(y, x) == x
    assert {"Will", "May", "Keller", "Rose", "00@x.org", "66@x.org", "+49 30 1000004"} <= set(forms) and "; May we? Will " in got[ids[0]].text


def test_pii_stays_distinct_where_formats_are_scarce(spark):
    """More entities than a two-digit local part can name: surrogates grow, none is shared or real."""
    entities = spark.createDataFrame([("email", f"{i:02d}@x.org") for i in range(100)], "kind string, canon string")
    attempts = {(r.kind, r.canon): r.attempt for r in pii.redrawn(entities, b"k").collect()}
    drawn = [pii.surrogate(b"k", "email", f"{i:02d}@x.org", attempts.get(("email", f"{i:02d}@x.org"), 0)) for i in range(100)]
    assert len(set(drawn)) == 100 and not set(drawn) & {f"{i:02d}@x.org" for i in range(100)}
    texts = [f"write to {i:02d}@x.org soon" for i in range(100)] * 2
    got = [r.text for r in pii.replace_entities(documents(spark, texts), b"k").orderBy("doc_id").collect()]
    assert got == [f"write to {d} soon" for d in drawn] * 2
    assert pii.replace_entities(documents(spark, texts).limit(0), b"k").isEmpty()


def base_counts(text):
    w = words(text)
    seen, covered = collections.Counter(zip(w, w[1:], w[2:], strict=False)), set()
    for i, t in enumerate(zip(w, w[1:], w[2:], strict=False)):
        if seen[t] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def distance(counts, shares):
    p = [c / sum(counts) for c in counts]
    return math.sqrt(max(0.0, sum(x * math.log2(x / ((x + y) / 2)) for a, b in zip(p, shares, strict=True) for x, y in ((a, b), (b, a)) if x > 0) / 2))


def quality_texts(seed=3):
    rng = random.Random(seed)
    common = quality_rules.COMMON_WORDS["en"]
    good = [" ".join(rng.choice(common) if rng.random() < 0.4 else x for x in prose(rng, 300)) for _ in range(12)]
    odd = ["a b a b a b", "x\n\nx\n x \ny\x0bz", "é ü 中\x85文 a\xa0b", "w " * 300, "\n".join(["same line here"] * 40), " ".join(f"w{i}##$%" for i in range(300)), None, "", " \n\t", "A1! " * 80]
    return good + odd


def test_quality_rules(spark):
    texts = quality_texts()
    docs = documents(spark, texts)
    rows = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    for i, text in enumerate(texts):
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base_counts(text), text
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert all(rows[i].kept for i in range(12)) and not rows[17].kept
    # distances by hand, against references of the long documents
    def classes(t):
        t = t or ""
        n = [sum(c in " \t\n\x0b\x0c\r" for c in t), *[sum(f(c) for c in t) for f in (lambda c: "A" <= c <= "Z", lambda c: "0" <= c <= "9", lambda c: c in ".,;:!?'\"()-", lambda c: c in "#*$%&|<>", lambda c: c > "\x7f")]]
        return [*n, len(t) - sum(n)]

    long = [t for t in texts if len(words(t)) >= 200 and len(t) >= 200 and 2 * base_counts(t)[4] <= len(words(t))]
    total = [sum(x) for x in zip(*map(classes, long), strict=True)]
    for i, t in enumerate(texts):
        if t:
            assert rows[i].class_distance == pytest.approx(distance(classes(t), [x / sum(total) for x in total]), abs=1e-9)
    kept = quality_rules.keep_good(docs.withColumnRenamed("n_chars", "kept"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, r in rows.items() if r.kept) and kept.columns[-1] == "kept"
    assert quality_rules.judge(docs.limit(0)).isEmpty() and quality_rules.keep_good(docs.limit(0)).isEmpty()
    russian = "Обычный текст о погоде и людях " * 3 + " ".join(f"слово{i}" for i in range(300))
    other = spark.createDataFrame([(99, russian, "ru", "a", 1)], docs.schema)
    (row,) = quality_rules.judge(docs.unionByName(other)).where("doc_id = 99").collect()
    assert row.kept and row.class_distance is None  # a language without a reference
    assert quality_rules.judge(docs.withColumnRenamed("lang", "x").selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")).where("kept").count() >= 12


@pytest.mark.parametrize("hashed", [0, 1])
def test_repeated_words_do_not_depend_on_the_hash(spark, monkeypatch, hashed):
    """With hashes that all collide, or collide by first word, the counts stay those of the words."""
    monkeypatch.setattr(quality_rules, "_window_hash", lambda *w: quality_rules.F.xxhash64(*w[:hashed], quality_rules.F.lit(1)))
    rng = random.Random(8)
    texts = [" ".join(prose(rng, n, v)) for n, v in [(3, 1), (4, 1), (60, 3), (60, 6), (200, 9), (300, 400)]] + ["a b c d e f a b c", "a b c d e f g h", None]
    rows = quality_rules.judge(documents(spark, texts)).orderBy("doc_id").collect()
    assert [r.n_repeat_words for r in rows] == [base_counts(t)[4] for t in texts]


def test_short_documents_are_judged_by_their_words(spark):
    import corpus_pipeline

    rng = random.Random(5)
    common = quality_rules.COMMON_WORDS["en"]
    def text(n, share):
        return " ".join(rng.choice(common) if rng.random() < share else x for x in prose(rng, n, 4000))
    texts = [text(400, 0.5) for _ in range(8)] + [text(n, 0.5) for n in (60, 120, 190)] + [text(n, 0) for n in (60, 120, 190)]
    kept = corpus_pipeline.quality(spark, documents(spark, texts), "")
    assert sorted(r.doc_id for r in kept.collect()) == list(range(11))


def test_license_scans(spark):
    filler = " ".join(f"word{i}" for i in range(30))
    files = [
        ("root/LICENSE", "MIT license\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
        ("root/a/x.txt", f"{filler}\nLicensed under the Apache License, Version 2.0.\n{filler * 20}"), ("root/a/y.txt", filler), ("root/b/c/z.txt", ""), ("root/b/NOTICE", "Licensed under CC BY-NC 4.0."),
        ("other/q.txt", None), (None, filler), ("top.txt", filler), ("root/b/c/z.txt", "a general version of any word1 word2 word3"),
    ]
    df = spark.createDataFrame(files, "path string, text string").selectExpr("*", "1 AS score", "2 AS dir")
    out = [(r.path, r.own_license, r.license, r.origin, r.from_dir) for r in license_scan.inherit(license_scan.scan(df).drop("dir")).collect()]
    assert sorted(out, key=str) == sorted(
        [("root/LICENSE", "MIT", "MIT", "own", None), ("root/a/x.txt", "Apache-2.0", "Apache-2.0", "own", None), ("root/a/y.txt", None, "MIT", "inherited", "root"), ("root/b/c/z.txt", None, "CC-BY-NC-4.0", "inherited", "root/b"), ("root/b/c/z.txt", None, "CC-BY-NC-4.0", "inherited", "root/b"),
         ("root/b/NOTICE", "CC-BY-NC-4.0", "CC-BY-NC-4.0", "own", None), ("other/q.txt", None, None, None, None), (None, None, None, None, None), ("top.txt", None, None, None, None)], key=str,
    )
    assert license_scan.inherit(license_scan.scan(df.limit(0)).drop("dir")).isEmpty()


def plain_scan(text, templates, titles, units, df, threshold=0.8, margin=0.005):
    """Every stretch that lies on a template at a decisive term, judged by plain cosines and sets of terms."""
    known = [(name, license_scan.terms(x)) for name, x in [*templates, *titles]]
    vocabulary = {t for _, x in known for t in x}
    idf = lambda t: math.log((1 + units) / (1 + df.get(t, 0))) + 1 if t in vocabulary else math.log(1 + units) + 1
    weigh = lambda x: {t: n * idf(t) for t, n in collections.Counter(x).items()}
    cosine = lambda a, b: sum(w * b.get(t, 0) for t, w in a.items()) / math.sqrt(sum(w * w for w in a.values()) * sum(w * w for w in b.values()))
    mass = lambda x: sum(idf(t) ** 2 for t in x)
    decisive = license_scan.Matcher(templates, units, df, threshold, titles).decisive
    low = (text or "").lower()
    spans = [(m.group(), *m.span()) for m in re.finditer(r"[a-z0-9]+(?:\.[a-z0-9]+)*", low)]
    found, covered, titled = {}, set(), False
    laid = {(max(0, p - o), min(len(spans), p - o + len(x))) for p, (t, _, _) in enumerate(spans) if t in decisive for _, x in known for o, y in enumerate(x) if y == t}
    vectors = [weigh(x) for _, x in known]
    for first, end in laid:
        unit = [s[0] for s in spans[first:end]]
        scores = [cosine(weigh(unit), v) for v in vectors]
        best = max(range(len(known)), key=lambda i: (round(scores[i], 12), -i))
        if round(scores[best], 12) < threshold:
            continue
        name, words_ = known[best][0], set(known[best][1])
        others = [(s, set(y), cosine(vectors[best], v)) for s, (n, y), v in zip(scores, known, vectors, strict=True) if n != name]
        part = lambda d: mass(d & set(unit)) / mass(d) if d else 0.5  # noqa: E731, B023
        before = low[spans[max(0, first - 4)][1] : spans[first][1]]
        sentence = re.split(r"[.!?;:]\s|\n[ \t\r]*\n", before)[-1]
        if (
            all(s <= scores[best] - margin for s, _, _ in others)
            and part(words_ - {t for n, y in known if n != name for t in y}) >= 0.5
            and all(part(words_ - y) > part(y - words_) for _, y, c in others if c >= license_scan.SIMILAR)
            and not (set(unit) & license_scan.NEGATIONS) - words_
            and not set(license_scan.terms(sentence)) & license_scan.NEGATIONS
        ):
            found[name] = max(found.get(name, 0), scores[best])
            covered |= set(range(first, end))
            titled = titled or best >= len(templates)
    if "BSD-3-Clause" in found:
        found.pop("BSD-2-Clause", None)
    if not found:
        return None, None, None
    score, name = max((round(s, 12), n) for n, s in found.items())
    return name, score, 1.0 if titled else len(covered) / len(spans)


def close(a, b):
    return a[0] == b[0] and a[1:] == pytest.approx(b[1:], abs=1e-9)


def test_license_matcher_agrees_with_plain_cosines():
    rng = random.Random(1)
    texts = [x for _, x in [*license_scan.TEMPLATES, *license_scan.TITLES]]
    vocabulary = sorted({t for x in texts for t in license_scan.terms(x)}) + [f"z{i}" for i in range(20)]
    df = {"the": 900, "of": 800, "this": 500, "is": 700, "and": 850, "to": 600}
    matcher = license_scan.Matcher(license_scan.TEMPLATES, 1000, df, 0.8, license_scan.TITLES)
    assert set(matcher.idf) - matcher.decisive
    matched = 0
    for _ in range(100):
        words_ = [w for _ in range(rng.randrange(1, 4)) for w in (rng.choice(texts).split() if rng.random() < 0.6 else rng.choices(vocabulary, k=rng.randrange(30)))]
        text = "".join(w + rng.choice([" ", " ", " ", "\n", "\n\n"]) for w in words_)
        want = plain_scan(text, license_scan.TEMPLATES, license_scan.TITLES, 1000, df)
        assert close(matcher.scan(text), want) if want[0] else matcher.scan(text) == want, text
        matched += want[0] is not None
    assert matched > 30


def test_license_notices_do_not_depend_on_what_follows(spark):
    """A notice wrapped over short lines scores the same alone and before code of any length; a title makes a licence file."""
    notice = "# This program is free software: you can\n# redistribute it and/or modify it under\n# the terms of the GNU General Public\n# License as published by the Free Software\n# Foundation, either version 3 of the License,\n# or (at your option) any later version.\n"
    code = "\n".join(f"x{i} = call(y{i}, z{i % 7})" for i in range(3000))
    files = [("a/1", notice), ("a/2", notice + code), ("a/3", code), ("b/LICENSE", "Apache License\nVersion 2.0, January 2004\n" + code), ("b/c/d", "nothing"), ("e/f", "word " * 200_000)]
    rows = {r.path: r for r in license_scan.inherit(common.materialize(license_scan.scan(spark.createDataFrame(files, "path string, text string")).drop("text"), "scanned")).collect()}
    assert rows["a/1"].own_license == rows["a/2"].own_license == "GPL-3.0" and rows["a/1"].score == rows["a/2"].score
    assert rows["a/3"].origin == "inherited" and rows["b/c/d"].license == "Apache-2.0" and rows["e/f"].license is None


FSF = "is free software; you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version."


@pytest.mark.parametrize(
    ("text", "license_"),
    [
        ("This program " + FSF.format("General Public License", "2"), "GPL-2.0"),
        ("This program " + FSF.format("General Public License", "3"), "GPL-3.0"),
        ("This program " + FSF.format("General Public License", "4"), None),
        ("This library " + FSF.format("Lesser General Public License", "2.1"), "LGPL-2.1"),
        ("This library " + FSF.format("Lesser General Public License", "3"), "LGPL-3.0"),
        ("This program " + FSF.format("Affero General Public License", "3"), "AGPL-3.0"),
        ("GNU GENERAL PUBLIC LICENSE\n   Version 2, June 1991", "GPL-2.0"),
        ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
        ("Licensed under CC BY 4.0.", "CC-BY-4.0"),
        ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"),
        ("Licensed under CC BY-NC-ND 4.0.", "CC-BY-NC-ND-4.0"),
        ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "CC-BY-4.0"),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
        ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "CC-BY-NC-4.0"),
        ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "BSD-2-Clause"),
        ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: one. two. Neither the name of the company nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.", "BSD-3-Clause"),
        ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software)", "MIT"),
        ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", "BSL-1.0"),
        ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "ISC"),
        ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.", "Zlib"),
        ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "CC0-1.0"),
        ("// SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0"),
        ("// SPDX-License-Identifier: MIT", "MIT"),
        ("// SPDX-License-Identifier: Sleepycat", None),
        ("This is not released under the MIT License.", None),
        ("It is no longer released under the MIT License.", None),
        ("This is not a library. Released under the MIT License.", "MIT"),
        ("Released under the MIT License. It is not slow.", "MIT"),
        ("Released under the Foo License.", None),
        ("Released under the MIT License. " + "then much else follows in this line " * 200, "MIT"),
        ("much else comes first in this line " * 200 + "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files " + "and more " * 500, "MIT"),
    ],
)
def test_licenses_are_told_apart(text, license_):
    for df in ({}, {"the": 900, "of": 800, "this": 500, "is": 700, "and": 850, "to": 600, "license": 60, "under": 90, "mit": 300, "by": 70, "3": 40, "2": 45}):
        matcher = license_scan.Matcher(license_scan.TEMPLATES, 1000, df, 0.8, license_scan.TITLES)
        assert matcher.scan(text)[0] == license_


def test_license_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    vocabulary = {t for _, x in [*license_scan.TEMPLATES, *license_scan.TITLES] for t in license_scan.terms(x)}
    lines = [set(license_scan.terms(x)) & vocabulary for r in docs for x in (r.text or "").lower().split("\n")]
    df = collections.Counter(t for line in lines for t in line)
    matcher = license_scan.Matcher(license_scan.TEMPLATES, len(lines), df, 0.8, license_scan.TITLES)
    own = {r.doc_id: matcher.scan(r.text) for r in docs}
    sources = {r.doc_id: r.source for r in docs}
    place = lambda i: [sources[i], str(i // 1000), str(i // 100)]
    speak = {}
    for i, (name, score, share) in own.items():
        if name and share >= 0.1:
            d = "/".join(place(i))
            speak[d] = min(speak.get(d, (0, "~", "")), (-score, f"{d}/{i}.txt", name))
    for r in queries.op4_license_scans(spark, SF).collect():
        ways = ["/".join(place(r.doc_id)[:n]) for n in (3, 2, 1)]
        near = next((speak[d][2] for d in ways if d in speak), None)
        assert (r.own_license, r.license) == (own[r.doc_id][0], own[r.doc_id][0] or near)


URLS = [
    "http://A.Example.NET/en/1?x#y", "https://b.net", "http://b.net/", "ftp://x.org/fr/a", "http://x.org/en/fr/", "http://example.com/de/", "http://notexample.com/de/", "http://h/?u=http://net/",
    "no scheme", None, "", "://", "http://net/a", "https://www.spam-farm.example.org/en/7/", "http://spam-farm.example.org/en/7", "http://x.example.net/en/\n2", "http://x.example.net/EN/",
]


def judge_plain(url, listed):
    import re

    m = re.search("://", url or "")
    host, path = "", ""
    if m:
        rest = url[m.end() :]
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host) :])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(h + p, v) for v, h, p in queries.URL_RULES if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        rule, verdict = max(fits, key=lambda x: len(x[0]))
        return host, path, rule, verdict
    key = (host[4:] if host.startswith("www.") else host) + " " + path.rstrip("/")
    return host, path, None, "block" if host and key in listed else "allow"


@pytest.mark.parametrize("limit", [0, 1 << 17])
@pytest.mark.parametrize("bits", [0, 16])
def test_urls(spark, monkeypatch, bits, limit):
    """No bits for a key make one block for everything, so many false positives; beyond the limit blocks are joined. The result is the same."""
    monkeypatch.setattr(url_filter, "BITS_PER_KEY", bits)
    monkeypatch.setattr(url_filter, "BROADCAST_BLOCKS", limit)
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS * 2)], "page_id bigint, url string, verdict string")
    many = [(f"h{i}.org /{i}",) for i in range(300)]
    listed = spark.createDataFrame([("spam-farm.example.org /en/7",), ("spam-farm.example.org /en/7",), (None,), *many], "canonical string")
    out = url_filter.judge(pages, url_filter.rule_table(spark, queries.URL_RULES), listed).collect()
    assert len(out) == 2 * len(URLS)
    for r in out:
        assert (r.host, r.path, r.rule, r.verdict) == judge_plain(URLS[r.page_id % len(URLS)], {"spam-farm.example.org /en/7"})
    assert url_filter.judge(pages.limit(0), url_filter.rule_table(spark, queries.URL_RULES), listed).isEmpty()
    nothing = url_filter.judge(pages, url_filter.rule_table(spark, queries.URL_RULES).limit(0), listed.limit(0))
    assert {r.verdict for r in nothing.collect()} == {"allow"}


def test_rules_of_equal_length(spark):
    """Of "b.net" + "/x" and "net" + "/x/y" (as long), the longer host decides."""
    pages = spark.createDataFrame([(1, "http://a.b.net/x/y")], "page_id bigint, url string")
    rules = [("allow", "b.net", "/x"), ("block", "net", "/x/y")]
    assert [(r.rule, r.verdict) for r in url_filter.judge(pages, url_filter.rule_table(spark, rules)).collect()] == [("b.net/x", "allow")]


def test_url_filter_passes_false_positives_to_the_join(spark, monkeypatch):
    """A filter of few bits passes unlisted keys too, and never loses a listed one; the query's list gives both verdicts."""
    monkeypatch.setattr(url_filter, "BITS_PER_KEY", 4)
    keys = spark.range(3000).selectExpr("concat('k', id) AS k")
    bloom = url_filter.BlockedBloom(keys.where("k < 'k2'"), "k")
    passed = {r.k for r in bloom.possible(keys, "k").collect()}
    listed = {f"k{i}" for i in range(3000) if f"k{i}" < "k2"}
    assert listed < passed and len(passed - listed) < 1500
    verdicts = {r.verdict for r in queries.op3_url_filters(spark, SF).where("rule IS NULL").collect()}
    assert verdicts == {"allow", "block"}


def test_a_text_is_judged_in_each_language_it_comes_in(spark):
    """The filter keeps just what the rules keep, also where a text comes under several languages."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rejected = quality_rules.judge(docs).where("NOT kept AND NOT base_failed").select("doc_id")
    again = docs.join(rejected, "doc_id")
    other = [again.withColumn("lang", F.lit(x).cast("string")).withColumn("doc_id", F.col("doc_id") + k) for k, x in ((100_000, None), (200_000, "ru"), (300_000, "xx"))]
    table = docs.unionByName(other[0]).unionByName(other[1]).unionByName(other[2])
    wanted = {r.doc_id for r in quality_rules.judge(table).where("kept").select("doc_id").collect()}
    got = [r.doc_id for r in quality_rules.keep_good(table).select("doc_id").collect()]
    assert len(got) == len(set(got)) and set(got) == wanted and sum(i >= 100_000 for i in wanted) > 30
