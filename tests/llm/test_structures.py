"""Conversation repair, the cuckoo index and the Merkle manifest against plain Python, on small tables with odd rows."""

import hashlib
import random
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from tenantferry.llm import cuckoo, merkle, queries, repair

BLANKS = " \t\n\x0b\x0c\r"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- conversations ------------------------------------------------------------------------------


def damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif kind == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {c: sorted(x, key=lambda r: (r[0] is not None, r[0] or 0, r[1], sha(r[2]))) for c, x in out.items()}


def mended(rows):
    """Counts, cost, audit and repaired lines of a conversation's rows, by trying every edit."""
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.strip(BLANKS)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}  # the last initial, and those that may come next

    @lru_cache(None)
    def best(i, last, put):
        ways = [(0, "", ())] if i == len(rows) and last in ("", "a") else []
        new = "assistant" if last == "u" else "user"

        def go(cost, letter, line, j, state, put=0):
            rest = best(j, state, put)
            if rest:
                ways.append((cost + rest[0], letter + rest[1], (line, *rest[2]) if line is not None else rest[2]))

        if put < 3:
            go(2, "I", new + ":", i, new[0], put + 1)
        if i < len(rows):
            _, role, text = rows[i]
            go(3, "D", None, i + 1, last)
            if faults[i] in ("", "truncated"):
                cut = faults[i] == "truncated"
                go(2 + cut, "R", f"{new}:{text}", i + 1, new[0])
                if role[:1] and role[:1] in follows[last]:
                    go(int(cut), "K", f"{role}:{text}", i + 1, role[0])
        return min(ways) if ways else None

    cost, audit, lines = best(0, "", 0)
    known = [r[0] for r in rows if r[0] is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (gaps, *(faults.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha("\n".join(lines)))


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
TEXTS = ["Hello there.", "Yes!", "No", " \t\n", "", None, "What?  ", "and then", "...", "é語😀?", "x" * 50_000, "Line one.\nLine two"]


def some_conversations():
    r = random.Random(7)
    rows = []
    for conv in [*range(60), None]:
        for turn in range(r.randint(1, 9)):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            rows.append((conv, r.choice([turn, turn, turn, None, turn // 2]), role, r.choice(TEXTS)))
    rows += rows[:5]  # repeated rows
    return rows


@pytest.mark.parametrize("block, parts", [(256, "8"), (3, "8"), (2, "40")])
def test_repair(spark, block, parts):
    rows = some_conversations()
    table = spark.createDataFrame([(*x, "clash", 1) for x in rows], "conv_id long, turn long, role string, text string, key string, copies int").repartition(3)
    held = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {r["conv_id"]: tuple(r[c] for c in NAMES) for r in repair.conversations(table, block).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)
    empty = (0, 0, 0, 0, 0, 0, "", sha(""))
    left = damage(rows)
    assert got == {c: mended(left[c]) if c in left else empty for c in {x[0] for x in rows}}


def test_repaired_turns_and_long_conversations(spark):
    r = random.Random(5)
    plain = lambda i: (i, r.choice(["user", "assistant"]), f"Say {i}" + r.choice([".", "!", ""]))
    rows = [("hot", *plain(i)) for i in range(3000)] + [("hot", 5000 + i, "user", "ok.") for i in range(2000)] + [(f"c{i}", j, "user", "Hi.") for i in range(50) for j in range(2)]
    frame = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string").withColumn("copies", F.when(F.col("turn") == 17, 40).otherwise(1))
    found = repair.blocks(frame, 100, keep_texts=True)
    got = {x["conv_id"]: x for x in repair.summary(found).collect()}
    # no task holds the long conversation: its steps lie in blocks of a bounded size
    longest = found.where("conv_id = 'hot'").selectExpr("max(size(counts)) m", "count(*) n").first()
    assert longest["m"] <= 102 and longest["n"] >= 30
    assert (got["c7"]["cost"], got["c7"]["audit"]) == (5, "KDI")
    lines = defaultdict(list)
    for x in repair.repaired_turns(found).collect():
        at = x["at"]
        lines[x["conv_id"]].append(((at["turn"], at["role"], at["key"]), [(t["role"], t["text"]) for t in x["turns"]]))
    for conv, parts in lines.items():
        spoken = [t for _, p in sorted(parts) for t in p]
        assert sha("\n".join(f"{a}:{b}" for a, b in spoken)) == got[conv]["sha256"]
        assert "".join(a[0] for a, _ in spoken) == "ua" * (len(spoken) // 2)
    # the same conversation as one block
    one, seen = repair.Block(), set()
    for _, turn, role, text in rows[:5000]:
        one.add(turn, role, text, 40 if turn == 17 else 1, (role, text) in seen, sha(text))
        seen.add((role, text))
    x = repair._record("hot", one, True, False)
    want = (x["high"] - x["low"] + 1 - x["turns"], x["blank"], x["duplicate"], x["truncated"], x["illegal"], x["costs"][0], x["audits"][0], x["sha256"])
    assert tuple(got["hot"][c] for c in (*NAMES[:-1], "sha256")) == want


def test_repair_of_nothing(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.conversations(none).count() == 0


# -- exact dedup --------------------------------------------------------------------------------

DOCS = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (6, "A"), (7, "a "), (3, "a"), (None, "b"), (None, "z"), (8, "x" * 100_000), (9, "x" * 100_000), (10, "é"), (11, "é")]


def kept_of(rows):
    best = {}
    for i, t in rows:
        t = t or ""
        n, keep = best.get(t, (0, None))
        best[t] = (n + 1, i if keep is None or (i is not None and i > keep) else keep)
    return best


def test_exact_dedup(spark):
    rows = DOCS + [(100 + i, "copy") for i in range(500)] + [(1000 + i, f"text {i}") for i in range(300)]
    docs = spark.createDataFrame([(*x, 0, "clash") for x in rows], "doc_id long, text string, part int, key string").repartition(5)
    got = cuckoo.documents(docs, part_keys=50).collect()
    assert len(got) == len(rows)
    want, texts = kept_of(rows), {sha(t or ""): t or "" for _, t in rows}
    stay = defaultdict(list)
    for r in got:
        text = texts[r["text_sha256"]]
        assert (r["group_size"], r["keep_id"]) == want[text]
        if r["kept"]:
            stay[text].append(r["doc_id"])
    # one row of each text, also of one given twice
    assert {t: [k] for t, (_, k) in want.items()} == stay
    assert cuckoo.documents(docs.limit(0)).count() == 0


def test_index_takes_insertions_and_deletions(spark):
    r = random.Random(11)
    live = []
    index = None
    for batch in range(4):
        new = [(r.randrange(400), f"t{r.randrange(60)}") for _ in range(120)]
        rows = cuckoo.digests(spark.createDataFrame(new, "doc_id long, text string"))
        before = index
        index = (index or cuckoo.Index.empty(rows)).insert(rows, part_keys=20)
        live += new
        gone = r.sample(sorted(set(live)), 25) + [(9999, "t1")]
        index = index.delete(cuckoo.digests(spark.createDataFrame(gone, "doc_id long, text string")))
        live = [x for x in live if x not in set(gone)]
        got = {bytes(x["key"]).hex(): (x["group_size"], x["keep_id"]) for x in index.groups().collect()}
        assert got == {sha(t): x for t, x in kept_of(live).items()}
        filters = [cuckoo.Filter(bytes(x["slots"])) for x in index.parts.where("slots is not null").collect()]
        assert sum(1 for f in filters for s in f.table if s) == len(got)
        if before:  # an earlier version is as it was
            assert before.groups().count() > 0
    assert index.n_parts > 1 and index.batches == 4


def test_cuckoo_filter_overflow_and_removal():
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    part = cuckoo.Part(None, {})
    for i, k in enumerate(keys):
        part.set(k, {"keep_id": i, "keep_batch": 0, "keep_row": 0, "group_size": 1})
    assert part.resized > 3 and all(k in part.filter for k in keys)
    others = [hashlib.sha256(b"o%d" % i).digest() for i in range(20_000)]
    hits = sum(k in part.filter for k in others)
    assert hits < 40 and not any(part.known(k) for k in others)  # a false hit is verified
    for k in keys[:1500]:
        part.set(k, {"keep_id": None, "keep_batch": 0, "keep_row": 0, "group_size": 0})
    assert all(k in part.filter for k in keys[1500:]) and sum(1 for s in part.filter.table if s) == 1500
    assert not any(part.known(k) for k in keys[:1500])


# -- manifest -----------------------------------------------------------------------------------


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes, at, changed=None):
    """Root of a tree, the siblings on the way, and the root with one node changed."""
    nodes, cur, others = list(nodes), changed or nodes[at], ""
    while len(nodes) > 1:
        first = at // 8 * 8
        run = nodes[first:first + 8]
        others += "".join(x for i, x in enumerate(run) if first + i != at)
        cur = sha("".join(cur if first + i == at else x for i, x in enumerate(run)))
        nodes = [sha("".join(nodes[i:i + 8])) for i in range(0, len(nodes), 8)]
        at //= 8
    return nodes[0], others, cur


def proofs(rows):
    by_lang = defaultdict(list)
    for doc_id, source, lang, n_chars, text in rows:
        head = "".join(map(field, (doc_id, source, lang, n_chars)))
        low = None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        leaf = sha(head + field(text))
        by_lang[lang].append((doc_id, leaf, sha(head + field(low)) if hit else leaf))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    for x in by_lang.values():
        x.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    subroots = [climb([r[1] for r in by_lang[x]], 0)[0] for x in langs]
    out = []
    for n, lang in enumerate(langs):
        leaves = [r[1] for r in by_lang[lang]]
        for i, (doc_id, leaf, changed) in enumerate(by_lang[lang]):
            sub, low, cur = climb(leaves, i, changed)
            root, high, top = climb(subroots, n, cur)
            out.append((doc_id, leaf, sub, root, sha(low + high), top, top == root))
    return out


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def as_rows(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("deep", [4, 1, 2])
def test_merkle(spark, deep):
    r = random.Random(9)
    rows = [(i, r.choice(["s", None]), r.choice(["en"] * 8 + ["de", "fr", None, "Z", "é"]), r.choice([None, i]), r.choice(["Text", "TEXT " * 9, "low", "", None, "É"])) for i in range(700)]
    rows += [(900, "s", f"l{i}", 1, "Only One") for i in range(12)] + [rows[3], (None, "s", "en", 2, "No Id"), rows[650]]
    docs = spark.createDataFrame([(*x, "clash", 0) for x in rows], "doc_id long, source string, lang string, n_chars long, text string, tree string, pos int").repartition(4)
    plain = [F.col(c) for c in merkle.FIELDS]
    low = F.translate("text", merkle.CAPITALS, merkle.SMALL)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    leaves = docs.select("lang", "doc_id", merkle.leaf(plain).alias("digest"), F.when(hit, merkle.leaf([*plain[:4], low])).alias("changed"))
    found = merkle.versions(leaves, deep).withColumn("verified", F.col("folded_root") == F.col("root")).collect()
    assert as_rows(tuple(x[c] for c in COLUMNS) for x in found) == as_rows(proofs(rows))
    # a version owns one node a level and shares the rest
    for x in found:
        assert bool(x["copies"]) == (not x["verified"]) and (not x["copies"] or x["copies"][-1] == x["folded_root"])


def test_merkle_of_little(spark):
    shape = "doc_id long, source string, lang string, n_chars long, text string"
    assert merkle.documents(spark.createDataFrame([], shape)).count() == 0
    for rows in ([(6, "a", None, 3, "ABC")], [(6, "a", "en", 3, "ABC"), (7, None, "de", None, None)], [(i, "a", "en", 1, "Q") for i in range(9)]):
        got = merkle.documents(spark.createDataFrame(rows, shape)).collect()
        assert as_rows(tuple(x[c] for c in COLUMNS) for x in got) == as_rows(proofs(rows))


@pytest.mark.parametrize("name", ["op11_repair", "op12_cuckoo", "op13_merkle"])
def test_queries_equal_their_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"create view {t} as select * from '/root/testdata/sf0.001/{t}.parquet'")
    rel = con.sql(queries.ORACLE[name])
    got = queries.QUERIES[name](spark, "/root/testdata/sf0.001").select(*rel.columns)
    assert sorted(map(str, rel.fetchall())) == sorted(str(tuple(x)) for x in got.collect())
