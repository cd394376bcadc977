import random
import zlib
from functools import lru_cache
from hashlib import sha256

import pytest

from cardlens.llm import conversations
from cardlens.llm.catalog import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, cost string, piece int, found long"
BLANK = " \t\n\x0b\x0c\r"


@pytest.fixture
def turns(spark):
    """Makes a table of turns with columns whose names clash with those of results."""

    def make(rows, parts=3):
        return spark.createDataFrame([(*r, "x", 7, 1) for r in rows], SCHEMA).repartition(parts)

    return make


def in_language(roles: str) -> bool:
    rest = roles[1:] if roles[:1] == "s" else roles
    return not roles or len(rest) > 0 and rest == "ua" * (len(rest) // 2)


def cheapest(kinds):
    """The least (cost, audit) by trying every edit of every turn; ``kinds``: initial and fault."""

    @lru_cache(None)
    def rest(at, roles, inserted):
        found = [(0, "")] if at == len(kinds) and in_language(roles) else []
        if inserted < 3:
            for role in "ua":
                if tail := step(at, roles + role, inserted + 1):
                    found.append((2 + tail[0], "I" + tail[1]))
        if at < len(kinds):
            initial, fault = kinds[at]
            if tail := step(at + 1, roles, 0):
                found.append((3 + tail[0], "D" + tail[1]))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                for cost, letter, role in ((0, "K", initial), (2, "R", "u"), (2, "R", "a")):
                    if tail := step(at + 1, roles + role, 0):
                        found.append((cost + more + tail[0], letter + tail[1]))
        return min(found) if found else None

    def step(at, roles, inserted):
        head, body = ("s", roles[1:]) if roles[:1] == "s" else ("", roles)
        if body != ("ua" * len(body))[: len(body)]:
            return None
        # all that matters of the pairs so far is how they end
        return rest(at, head + ("u" if len(body) % 2 else "ua" if body else ""), inserted)

    return rest(0, "", 0)


def brute(rows):
    """Findings and repaired turns of one conversation, turns in order."""
    seen, kinds, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, role, text in rows:
        body = text.strip(BLANK)
        if not body:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        else:
            fault = "none" if body[-1] in ".!?" else "truncated"
        seen.add((role, text))
        if fault != "none":
            counts[fault] += 1
        kinds.append((role[:1] or "-", fault))
    numbers = {t for t, _, _ in rows if t is not None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit = cheapest(tuple(kinds))
    out, left = [], list(rows)
    for letter in audit:
        row = None if letter == "I" else left.pop(0)
        if letter == "D":
            continue
        body = [r for r, _ in out if r[0] != "s"]
        wanted = "assistant" if len(body) % 2 else "user"
        out.append((row[1], row[2]) if letter == "K" else (wanted, "" if letter == "I" else row[2]))
    assert not left and in_language("".join(r[0] for r, _ in out))
    digest = sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (gaps, *counts.values(), illegal, cost, audit, digest), out


NAMES = (
    "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256",
)


def found(df):
    return {r.conv_id: tuple(r[n] for n in NAMES) for r in df.collect()}


def random_turns(n, seed):
    """Conversations with distinct turn numbers."""
    random.seed(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    texts = ["Yes.", "No!", "Why?", "and then", "", " \t", None, "done. ", "é", "Yes.\n"]
    made = {}
    for conv in range(n):
        numbers = sorted(random.sample(range(20), random.randint(1, 9)))
        made[conv] = [(t, random.choice(roles), random.choice(texts)) for t in numbers]
    return made


def spaced(rows):
    return [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]


def test_against_every_edit(turns):
    made = random_turns(120, seed=2)
    made[1000] = [(None, "user", "Hm."), (3, "assistant", "Yes.")]
    rows = [(c, *turn) for c, some in made.items() for turn in some]
    got = found(conversations.repair(turns(rows, 5)))
    assert got == {c: brute(spaced(some))[0] for c, some in made.items()}


def test_repaired_turns(turns):
    made = random_turns(40, seed=3)
    rows = [(c, *turn) for c, some in made.items() for turn in some]
    got = {}
    for r in conversations.repaired_turns(turns(rows)).orderBy("conv_id", "position").collect():
        assert r.position == len(got.setdefault(r.conv_id, []))
        got[r.conv_id].append((r.role, r.text))
    expected = {c: brute(spaced(some))[1] for c, some in made.items()}
    assert got == {c: out for c, out in expected.items() if out}


def test_a_conversation_over_many_ranges(spark, turns):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        random.seed(8)
        long = [
            (t, random.choice(["user", "assistant", "system"]), random.choice(["Yes.", "no", ""]) + str(t // 3) + ".")
            for t in range(400)
        ]
        rows = [(7, *turn) for turn in long] + [(8, 0, "user", "Hello."), (6, 5, "assistant", "Bye.")]
        base = turns(rows, 6)
        narrow = conversations._rows(base, "conv_id", "turn", "role", "text")
        assert conversations._pieces(narrow).where("conv = 7").count() > 3
        got = found(conversations.repair(base))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    # one piece holds the same rows in one task
    whole = found(conversations.repair(turns(rows, 1).coalesce(1)))
    assert got == whole
    assert got[7][1:3] == brute_counts(long)


def brute_counts(rows):
    seen, duplicate, blank = set(), 0, 0
    for _, role, text in rows:
        if not text.strip(BLANK):
            blank += 1
        elif (role, text) in seen:
            duplicate += 1
        seen.add((role, text))
    return blank, duplicate


def test_cells_split_anywhere():
    random.seed(4)
    for _ in range(50):
        codes = "".join(random.choices(list(conversations.CODES), k=random.randint(2, 9)))
        at = random.randint(1, len(codes) - 1)
        halves = conversations.combined(conversations.parse(codes[:at]), conversations.parse(codes[at:]))
        assert halves == conversations.parse(codes)


def test_ties_go_to_the_least_audit():
    user, assistant = ("u", "none"), ("a", "none")
    code = {kind: c for c, kind in conversations.CODES.items()}
    for kinds in [(user, user), (assistant,), (assistant, user), (user, ("x", "none"), assistant)]:
        assert conversations.best(conversations.parse("".join(code[k] for k in kinds))) == cheapest(kinds)


def test_rows_alike_ties_nulls_and_no_rows(turns):
    assert conversations.repair(turns([])).count() == 0
    rows = [(1, 0, "user", "Yes.")] * 3 + [(None, None, None, None), (None, 2, "user", "No.")]
    rows += [(2, 1, "assistant", "B."), (2, 1, "user", "A.")]
    got = found(conversations.repair(turns(rows)))
    assert got[1][:5] == (0, 0, 2, 0, 2) and got[1][6] == "KDDI"
    assert got[None][:5] == (0, 1, 0, 0, 1)
    assert got[2] == brute([(1, "assistant", "B."), (1, "user", "A.")])[0]  # ties by role


def test_frequent_texts_shuffled(turns, no_broadcast):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", "Same." if t else "Hi.") for c in range(60) for t in range(6)]
    got = found(conversations.repair(turns(rows, 6)))
    one = brute([(t, r, x) for c, t, r, x in rows if c == 0])[0]
    assert set(got.values()) == {one}


def damaged(rows):
    made = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        fault = zlib.crc32(key.encode()) % 20
        if fault == 1:
            text = ""
        elif fault == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif fault == 4:
            role = "user"
        made += [(turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return made


def test_query_against_every_edit(spark):
    folder = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{folder}/conversations.parquet").orderBy("conv_id", "turn").collect()
    convs = {}
    for r in table:
        convs.setdefault(r.conv_id, []).append(tuple(r))
    got = found(QUERIES["op13_conversation_repair"](spark, folder))
    empty = (0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())
    for conv, rows in convs.items():
        left = damaged(rows)
        assert got[conv] == (brute(left)[0] if left else empty)
    assert len(got) == len(convs)


def test_query_with_nulls_and_dropped_conversations(spark, tmp_path):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(dropped, 0, "user", "Hi."), (None, 1, "user", "Hi."), (None, None, None, "Yes."), (5, 2, "user", None)]
    spark.createDataFrame([(*r, "x", 7, 1) for r in rows], SCHEMA).write.parquet(
        str(tmp_path / "conversations.parquet")
    )
    got = found(QUERIES["op13_conversation_repair"](spark, str(tmp_path)))
    empty = (0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())
    assert got[dropped] == empty and set(got) == {dropped, None, 5}
    left = sorted(damaged(rows[1:3]), key=lambda r: (r[0] is not None, r[0]))
    assert got[None] == (brute(left)[0] if left else empty)
