"""Token output, mixing, decontamination, personal data, URL rules and the pipeline."""
import hashlib
import re
import sys
import zlib
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lociframe.llm import bitplanes, decontamination, entropy_mixing, pii, queries, url_rules

from .helpers import SCHEMA, WORD, awkward, frame, lower

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(queries.TOKENIZER)


@pytest.fixture(scope="module")
def rows():
    return awkward()


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 49_407), min_size=1, max_size=300), st.sampled_from(["bit", "byte"]))
def test_planes_round_trip(ids, unit):
    a = np.array(ids, np.uint32)
    assert (bitplanes.from_planes(bitplanes.to_planes(a, unit, 16), len(a), unit) == a).all()


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_ids_word_by_word_are_those_of_the_text(text):
    tokenizer = Tokenizer.from_file(PATH)
    assert np.frombuffer(bitplanes.encoder(PATH).of(text.encode()), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["It's DON'T we'Ll.", "a,b.. c!?", "x<|endoftext|>y <|ENDOFTEXT|>", "ÉA\u0301 \u00a0z\u2003q", "1.5,000 ab12.", "end.', 'S"])
def test_ids_of_odd_texts(tokenizer, text):
    assert np.frombuffer(bitplanes.encoder(PATH).of(text.encode()), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["J\u030c", "H\u0331", "T\u0308", "W\u030a", "Plain J\u030cW\u030aA, H\u0331\u0301 WORDS."])
def test_ids_of_capitals_with_marks(tokenizer, text):
    assert np.frombuffer(bitplanes.encoder(PATH).of(text.encode()), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@given(st.binary(max_size=50), st.binary(max_size=50))
def test_crc_of_joined_parts(a, b):
    assert bitplanes.joined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


@pytest.mark.parametrize("unit", ["bit", "byte"])
def test_token_store(spark, rows, tokenizer, tmp_path, unit):
    folder = str(tmp_path / "store")
    bitplanes.write_tokens(frame(spark, rows), folder, PATH, 2, unit, block_ids=1000, width=16)
    pieces = bitplanes.read_pieces(spark, folder, unit)
    got = sorted(((r.start, r.n_tokens, r.doc_id, r.ids_crc32) for r in bitplanes.document_digests(pieces).collect()))
    ids = [(r[0], [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2]) for r in rows]
    assert [g[2] is not None for g in got] == sorted(g[2] is not None for g in got)
    assert [g[2] for g in got if g[2] is not None] == sorted(i for i, _ in ids if i is not None)
    at = 0
    for start, n, _, _ in got:
        assert start == at
        at += n
    crc = sorted((repr(i), len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in ids)
    assert sorted((repr(g[2]), g[1], g[3]) for g in got) == crc
    assert sorted(i for r in pieces.select("ids").collect() for i in r.ids) == sorted(i for _, x in ids for i in x)
    index = spark.read.parquet(f"{folder}/index").orderBy("first_id").collect()
    assert index[0].first_id == 0 and all(a.first_id + a.n_ids == b.first_id for a, b in zip(index, index[1:], strict=False))


def test_token_store_of_no_rows(spark, tmp_path):
    folder = str(tmp_path / "store")
    bitplanes.write_tokens(spark.createDataFrame([], SCHEMA), folder, PATH, 2)
    assert bitplanes.document_digests(bitplanes.read_pieces(spark, folder)).count() == 0


def water_fill(sizes, share=1.5, cap=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        total = sum(weight[s] for s in free)
        above = {s for s in free if left * weight[s] / total > cap * sizes[s]}
        if not above:
            break
        out |= {s: cap * sizes[s] for s in above}
        left -= sum(out[s] for s in above)
        free -= above
    return out | {s: left * weight[s] / sum(weight[x] for x in free) for s in free}


@pytest.mark.parametrize("cell_rows", [10_000, 2])
def test_mix_meets_its_targets(spark, rows, cell_rows):
    rows = [r for r in rows if len(r[1] or "") < 50_000]
    got = entropy_mixing.mix(frame(spark, rows), cell_rows=cell_rows).collect()
    assert len(got) == len(rows)
    sizes, taken = {}, {}
    for r in got:
        n = len(WORD.findall(r.text or ""))
        assert r._mix["size"] == n and 0 <= r._mix["copies"] <= 2 and r["size"] in (5, None)
        sizes[r.source] = sizes.get(r.source, 0) + n
        taken[r.source] = taken.get(r.source, 0) + n * r._mix["copies"]
    expected = water_fill(sizes)
    for r in got:
        assert r._mix["source_size"] == sizes[r.source] and abs(r._mix["target"] - expected[r.source]) < 1e-6 * expected[r.source]
    assert all(abs(taken[s] - t) < 0.02 * t for s, t in expected.items())
    again = entropy_mixing.mix(frame(spark, rows[::-1]), cell_rows=cell_rows).collect()
    assert sorted(repr((r.doc_id, r.text, r._mix["copies"])) for r in got) == sorted(repr((r.doc_id, r.text, r._mix["copies"])) for r in again)


@pytest.mark.parametrize("share", [1.2, 0.8])
def test_mix_mends_a_long_document_with_many_short_ones(spark, share):
    rows = [(0, "w " * 100_000, *[None] * 8)] + [(i, f"w{i} " * 50, *[None] * 8) for i in range(1, 2001)]
    got = entropy_mixing.mix(frame(spark, rows), share=share, cell_rows=300).select("_mix.*").collect()
    assert len(got) == 2001 and all(0 <= r.copies <= 2 for r in got)
    assert abs(sum(r["size"] * r.copies for r in got) - share * 200_000) <= 25


def test_mix_of_few_rows(spark):
    assert entropy_mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    one = entropy_mixing.mix(spark.createDataFrame([(1, None, *[None] * 8), (2, "", *[None] * 8)], SCHEMA)).collect()
    assert [r._mix["copies"] for r in one] == [1, 1]


def plain_decontamination(text, items, window):
    norm = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    words, hit, found = norm(text), set(), set()
    for item, t in items:
        w = norm(t)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            for k in range(len(words) - n + 1):
                if words[k : k + n] == w[i : i + n]:
                    hit |= set(range(k, k + n))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("part_bytes", [1 << 25, 200])
def test_decontamination_matches_plain_python(spark, rows, part_bytes):
    rows = [r for r in rows if len(r[1] or "") < 20_000]
    items = [(1, " ".join((rows[3][1]).split()[5:40]).upper()), (2, "Two Words"), (3, None), (4, "..."), (5, rows[8][1][30:200]), (10, "two words"), (None, "one"), (6, "日本語")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.decontaminate(frame(spark, rows), benchmark, part_bytes=part_bytes).collect()
    assert len(got) == len(rows)
    listed = [(i, t) for i, t in items if i is not None]
    for r in got:
        d = r.decontamination
        assert (d.n_words, d.n_hit, list(d["items"])) == plain_decontamination(r.text, listed, 10)
        hit = sum(len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower((r.text or "")[s.start : s.end]))) for s in d.spans)
        assert hit == d.n_hit
    empty = decontamination.decontaminate(frame(spark, rows), benchmark.filter("false"))
    assert empty.agg(F.sum("decontamination.n_hit")).first()[0] == 0
    assert decontamination.decontaminate(spark.createDataFrame([], SCHEMA), benchmark).count() == 0


KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    def passes(kind, m):
        d = re.sub("[^0-9]", "", m)
        if kind == "ip":
            return all(int(x) <= 255 for x in m.split("."))
        if kind == "card":
            return 16 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(map(int, d[::-1]))) % 10 == 0
        return kind == "email" or 8 <= len(d) <= 15

    return [f"{k}:{m.start()}:{m.end()}" for k, p in KINDS.items() for m in re.finditer(p, text or "") if passes(k, m[0])]


ODD = [
    "a@b.c_d@e.f x@y", "@@ a@b.co.uk. é.é@a.b", "1.2.3.4.5.6.7.8 256.1.1.1 000255.0.0.1 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1111-1 12 4111111111111112",
    "+1 (555) 010-9999 +123 +12345678) +9 .. 1234567890123456789", "日本 a@b.c é+4915112345678", "mail: x.y%z+q@host-1.example.org,b@c.d", "1" * 5000, "a" * 5000 + "@b.c",
    'token = "0123456789abcdef0123456789abcdef01234567" Version 2.0', None, "", "call 030 1234567 now", "+1" * 50,
]


def test_base_spans_match_plain_python(spark):
    rows = [(i, t, *[None] * 8) for i, t in enumerate(ODD)]
    found = pii.candidates(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        assert [f"{s.kind}:{s.start}:{s.end}" for s in r._spans if s.base] == plain_spans(r.text)


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(alphabet="a1+@.-( )_é49", max_size=40), min_size=300, max_size=300))
def test_base_spans_of_random_texts(spark, texts):
    for r in pii.candidates(frame(spark, [(i, t, *[None] * 8) for i, t in enumerate(texts)])).collect():
        assert [f"{s.kind}:{s.start}:{s.end}" for s in r._spans if s.base] == plain_spans(r.text)


def test_classifier_adds_secrets_and_keeps_base_spans(spark):
    secret = hashlib.sha1(b"x").hexdigest()
    rows = [(i, f'the token = "{hashlib.sha1(bytes([i])).hexdigest()}" of a{i}@b.org', *[None] * 8) for i in range(40)]
    rows += [(100 + i, f"plain words of number {i}234567 and loremipsumdolorsitamet1b2c3d in prose", *[None] * 8) for i in range(40)]
    found = pii.candidates(frame(spark, rows))
    got = {r.doc_id: [s.kind for s in r.s] for r in found.select("doc_id", pii.personal_spans(pii.fit(found)).alias("s")).collect()}
    assert all(got[i] == ["email", "secret"] for i in range(40)) and all(got[100 + i] == [] for i in range(40)) and len(secret) == 40
    empty = pii.candidates(spark.createDataFrame([], SCHEMA))
    assert empty.select(pii.personal_spans(pii.fit(empty))).count() == 0


def test_url_rules_of_odd_urls(spark):
    rules = [("block", "b.c", "/x"), ("allow", "a.b.c", "/x"), ("allow", "c", ""), ("block", "c", ""), ("block", "", "/root"), ("allow", None, "/"), ("block", "d", "/é/")]
    urls = ["http://A.b.C/xyz?q", "http://zb.c/x", "http://q.b.c", "https://c", "b.c/x", None, "", "x://d/é/1#f", "x://d.:80/é/", "a://b://c/x", "http://ab.c/x/y", "http://b.c/x"]
    got = url_rules.judge_urls(spark.createDataFrame([*enumerate(urls), (0, urls[0]), (None, "http://c/")], "page_id long, url string"), spark.createDataFrame(rules, "action string, host string, path string"), prefix_digits=1)
    table = got.collect()
    assert len(table) == len(urls) + 2
    for r in table:
        if r.page_id is None:
            continue
        rest = (urls[r.page_id] or "").partition("://")[2]
        host = lower(re.match(r"[^/?#]*", rest)[0])
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        assert (r.host, r.path) == (host, path)
        fits = [(len(h + p), h + p, a) for a, h, p in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits) if fits else (0, None, "allow")
        assert (r.rule, r.verdict) == best[1:]
    assert url_rules.judge_urls(spark.createDataFrame([(1, "a://b/c")], "page_id long, url string"), spark.createDataFrame([], "action string, host string, path string")).first().verdict == "allow"


@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in "documents pages benchmark labels".split():
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    df = queries.QUERIES[name](spark, FOLDER)
    found = con.execute(queries.CHECKS[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    plain = lambda r: repr([round(x, 5) if isinstance(x, float) else x for x in r])
    assert sorted(plain([r[c] for c in names]) for r in df.collect()) == sorted(map(plain, found.fetchall()))


def test_pipeline_stages(spark, rows, tokenizer):
    sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
    import corpus_pipeline as p

    rows = [r for r in rows if len(r[1] or "") < 20_000]
    docs = frame(spark, rows)
    stages = dict(p.STAGES)
    clean = stages["quality_rules"](spark, docs, FOLDER)
    assert clean.columns == docs.columns
    kept = clean.collect()
    assert not any((r.text or "").startswith(("of***", "OF!!", "again")) or r.text is None for r in kept) and len(kept) > 60
    single = stages["near_duplicates"](spark, docs, FOLDER)
    assert single.columns == docs.columns
    from .helpers import groups, links, shingles

    texts = [r[1] for r in rows]
    head = groups(len(rows), links(texts))
    left = single.collect()
    assert sum(bool(shingles(r.text)) for r in left) == len({head[i] for i, t in enumerate(texts) if shingles(t)})
    assert {r.doc_id for r in left if shingles(r.text)} == {min(rows[j][0] for j in range(len(rows)) if head[j] == head[i] and rows[j][0] is not None) for i, t in enumerate(texts) if shingles(t)}
    safe = stages["decontamination"](spark, docs, FOLDER)
    assert safe.columns == docs.columns and safe.count() == len(rows)
    mixed = stages["mixing"](spark, docs, FOLDER)
    assert mixed.columns == docs.columns
    ids = stages["token_ids"](spark, mixed, FOLDER).collect()
    crc = {repr(r[0]) + str(zlib.crc32(np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2], "<u4").tobytes())) for r in rows}
    assert len(ids) == mixed.count() and {repr(r.doc_id) + str(r.ids_crc32) for r in ids} <= crc


def test_pipeline_query(spark):
    import corpus_pipeline as p

    got = p.run(spark, FOLDER)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() > 100


def test_latin_words_get_the_ids_of_whole_texts():
    """Words of ASCII and Latin-1 letters take a short way to the model; combining marks and other scripts beside them do not."""
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    whole, ids = Tokenizer.from_file(path), bitplanes._Ids(Tokenizer.from_file(path))
    rng = random.Random(5)
    letters = [chr(c) for c in range(0xC0, 0x100)] + list("abcdefgXYZ") * 6
    odd = [*letters, *"̌́.,'-1ªµİǅẞ日"]
    for k in range(3000):
        pool = odd if k % 3 else letters
        text = " ".join("".join(rng.choice(pool) for _ in range(rng.randint(1, 9))) + rng.choice(["", ".", ",", "..."]) for _ in range(rng.randint(1, 9)))
        assert np.frombuffer(ids.of(text.encode()), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_marks_after_letters_are_encoded_once():
    """Letters with marks behind them take the short way, whatever the marks; a contraction is left to the tokenizer."""
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    class Counted:
        def __init__(self, tokenizer):
            self.inner, self.model, self.pre_tokenizer, self.calls = tokenizer, tokenizer.model, tokenizer.pre_tokenizer, 0

        def encode(self, *args, **options):
            self.calls += 1
            return self.inner.encode(*args, **options)

    path = public_tokenizers.path("word_bpe_49k.json")
    whole, counted = Tokenizer.from_file(path), Counted(Tokenizer.from_file(path))
    ids, rng = bitplanes._Ids(counted), random.Random(6)
    marks = ["", ".", ",", "***", "$$$", "###", "!!", "),", "<|", "|>", "_", "=", "^", "`", "~"]
    words = ["".join(rng.choice("abcdeéñÜß") for _ in range(rng.randint(2, 9))) + rng.choice(marks) for _ in range(2000)]
    text = " ".join(w for w in words if "<" not in w)
    assert np.frombuffer(ids.of(text.encode()), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
    assert counted.calls <= len(marks)
    for text in [*words, "it's", "ABC's.", "l'É'", "x'.", "É'S***", "≠", "a<|x|>", "<|endoftext|>...", "ÀB'll", "¿Qué?", "«Él»", "º1ª.", "µ.", "Å.", "Å."]:
        assert np.frombuffer(ids.of(text.encode()), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text
