"""Variant spellings of names: canonical rewritings, equi-joins on them, scoring by rarity."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.runtime import checkpoint, spread

# Legal forms and words added around a name.
LEGAL = set("ltd limited inc incorporated llc plc gmbh corp corporation sa co company pty ag bv nv llp lp pvt sarl srl spa oy ab kg kk sas as aps".split())
ADDED = set("team group hiring careers jobs recruitment hq office emea kenya holding holdings".split())
# Words for what a firm does, and their short forms.
SECTORS = set(
    "analytics aviation agritech capital consulting energy foods genomics health insurance learning logistics media mining motors networks payments robotics security software solutions systems technologies textiles travel "
    "associates partners studio bank banking pharma chemicals construction design education electronics engineering fashion finance gaming hospitality industries interactive labs laboratories legal marketing materials "
    "medical mobility retail services shipping telecom trading transport ventures water works".split()
)
SHORT = {
    "anlytcs": "analytics", "anl": "analytics", "av": "aviation", "agri": "agritech", "cap": "capital", "cons": "consulting", "eng": "engineering", "gen": "genomics", "hlth": "health", "ins": "insurance",
    "log": "logistics", "logs": "logistics", "med": "media", "min": "mining", "mtrs": "motors", "net": "networks", "nets": "networks", "ntwks": "networks", "pmts": "payments", "pay": "payments", "rob": "robotics", "sec": "security",
    "soft": "software", "sw": "software", "sol": "solutions", "soln": "solutions", "solns": "solutions", "sys": "systems", "syst": "systems", "tech": "technologies", "techs": "technologies", "tex": "textiles", "trvl": "travel",
    "assoc": "associates", "assocs": "associates", "ptnrs": "partners", "svcs": "services", "labs": "labs", "intl": "international",
}
# Given names with their usual short forms.
NICKNAMES = {
    "abigail": "abby abbie gail", "alexander": "alex alec sandy xander", "andrew": "andy drew", "anthony": "tony", "benjamin": "ben benny benji", "catherine": "cathy cate", "charles": "charlie chuck", "christopher": "chris kit topher",
    "daniel": "dan danny", "david": "dave", "deborah": "deb debbie", "edward": "ed eddie ned", "elizabeth": "liz beth lizzie betty eliza", "frederick": "fred freddie", "gabriela": "gabi gaby", "gregory": "greg", "james": "jim jimmy jamie",
    "jennifer": "jen jenny", "john": "johnny jack", "jonathan": "jon", "joseph": "joe", "josephine": "jo josie", "katherine": "kate kathy katie kat", "lawrence": "larry", "margaret": "maggie meg peggy", "matthew": "matt", "michael": "mike mick mickey",
    "nathaniel": "nate nat nathan", "nicholas": "nick", "patricia": "pat patty", "patrick": "paddy", "peter": "pete", "philip": "phil", "richard": "rick dick rich", "robert": "bob rob bobby robbie", "samuel": "sam", "stephen": "steve",
    "susanna": "sue susie suzy", "theodore": "ted theo teddy", "thomas": "tom tommy", "timothy": "tim", "victoria": "vicky", "william": "bill will billy liam",
}
NICK = {n: g for g, ns in NICKNAMES.items() for n in ns.split()}
#: What firms named after a person call themselves.
PERSONAL = {"consulting", "studio", "associates", "partners", "&co", "&sons"}
MAX_EDITS = 3


def edits(a: str, b: str, most: int = 3) -> int:
    """Edit distance with swaps of neighbours as one edit; more than `most` comes out as most + 1."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            d = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if last is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, last[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
    return min(row[-1], most + 1)


@lru_cache(1 << 16)
def sector_of(word: str) -> str | None:
    """The sector a word stands for: itself, its short form, or one it misspells."""
    if word in SECTORS:
        return word
    if word in SHORT:
        return SHORT[word]
    if len(word) < 4 or word in NICK or word in NICKNAMES:
        return None
    near = min(((edits(word, s, 2), s) for s in SECTORS if len(s) >= 5), default=(9, ""))
    most = 2 if len(near[1]) >= 7 and len(word) >= 6 or len(near[1]) >= 6 and len(word) >= 5 and word[0] == near[1][0] else 1
    return near[1] if near[0] <= most else None


@lru_cache(1 << 16)
def legal(word: str) -> bool:
    return word in LEGAL or (len(word) >= 5 and any(len(w) >= 5 and edits(word, w, 1) <= 1 for w in LEGAL))


@lru_cache(1 << 16)
def misspelt_legal(word: str) -> bool:
    return len(word) <= 9 and any(edits(word, w, 1) <= 1 for w in LEGAL if len(w) >= 3)


def parse(name: str) -> tuple[list[str], str]:
    """(core words, sector) of a name, in their rewritten form; the sector is empty where none is named.

    Remarks in brackets, legal forms, `The … Team` and signs fall away, words run together by capitals
    are cut, the part behind a comma comes first, short forms and nicknames are written out.
    """
    s = unicodedata.normalize("NFKC", name)
    s = re.sub(r"[(\[{][^)\]}]*[)\]}]?", " ", s)
    s = re.sub(r"[®™©'’`]", "", s)
    if not re.search(r"[\s_,/-]", s.strip()):
        s = re.sub(r"(?<=[a-zà-ÿ])(?=[A-ZÀ-Þ])", " ", s)
    s = re.sub(r"\b([A-Za-z])\.([A-Za-z])\.(?:([A-Za-z])\.)?", r"\1\2\3", s.lower())
    s = re.sub(r"\band\b", "&", s)
    parts = [re.findall(r"&|[^\W_]+", p) for p in s.split(",")]
    parts = [p for p in parts if p and not all(legal(w) for w in p)] or parts[:1]
    words = [w for p in reversed(parts) for w in p] if len(parts) == 2 else [w for p in parts for w in p]
    if len(parts) == 2 and len(parts[1]) > 1:  # Family, G. & Partners; Family, G. Associates
        cut = parts[1].index("&") if "&" in parts[1] else len(parts[1]) - bool(sector_of(parts[1][-1]))
        if cut:
            words = [*parts[1][:cut], *parts[0], *parts[1][cut:]]
    if len(words) > 1 and words[0] in ("the", "teh"):
        words = words[1:]
    sector, changed = "", True
    while changed and len(words) > 1:
        changed = False
        last = words[-1]
        if words[-2] == "&" and (last in ("co", "company", "partners", "associates", "sons") or edits(last, "partners", 2) <= 2):
            sector = sector or {"co": "&co", "company": "&co", "sons": "&sons"}.get(last) or sector_of(last) or last
            words, changed = words[:-2], True
        elif legal(last) or last in ADDED or (len(words) > 2 and sector_of(words[-2]) and not sector_of(last) and misspelt_legal(last)):
            words, changed = words[:-1], True
        elif not sector and len(words) > 2 and words[-2] + last in SECTORS:
            sector, words, changed = words[-2] + last, words[:-2], True
        elif not sector and sector_of(last):
            sector, words, changed = sector_of(last), words[:-1], True
    if not sector and len(words) > 1 and sector_of(words[0]) and len(parts) == 1 and words[0] in SECTORS:
        sector, words = words[0], words[1:]
    core = [NICK.get(w, w) for w in words if w != "&"] or words
    if len(core) > 1 and (sector in PERSONAL or not sector) and not any(map(is_given, core)):
        core = [given_of(w) or w for w in core[:1]] + core[1:]
    return core, sector


@lru_cache(1 << 16)
def given_of(word: str) -> str | None:
    """The given name that a misspelt word stands for."""
    if len(word) < 3:
        return None
    near = [n for n in (*NICKNAMES, *NICK) if len(n) >= 3 and n[0] == word[0] and edits(word, n, 1) <= 1]
    return NICK.get(near[0], near[0]) if near else None


def is_initial(word: str) -> bool:
    return len(word) == 1


def is_given(word: str) -> bool:
    return word in NICKNAMES


def token_edits(a: str, b: str) -> int:
    """Edits between two core words, 9 where they are too many for their length."""
    if a == b:
        return 0
    short = min(len(a), len(b))
    most = 0 if short < 3 else 1 if short < 6 else 2
    d = edits(a, b, most)
    return d if d <= most else 9


def compare(a: tuple[list[str], str], b: tuple[list[str], str]) -> tuple[str, int] | None:
    """How two parsed names can be one: (`full`, edits) or (`lossy`, edits), None where they can't.

    Full: every word of one has its counterpart, the sectors agree. Lossy: an initial stands for a
    word, a sector or a given name is missing. A shared word alone is never enough.
    """
    (ca, sa), (cb, sb) = a, b
    lossy = False
    if sa != sb:
        if sa and sb:
            return None
        lossy = True
        if min(len(ca), len(cb)) < 2:
            return None
    if len(ca) != len(cb):
        long, short = (ca, cb) if len(ca) > len(cb) else (cb, ca)
        if len(long) != 2 or len(short) != 1 or not sa or is_initial(short[0]):
            return _joined(ca, cb) if not lossy else None
        if not any(is_given(w) or is_initial(w) for w in long):
            return _joined(ca, cb) if not lossy else None
        d = min(token_edits(short[0], w) for w in long if not is_given(w) and not is_initial(w)) if any(not is_given(w) and not is_initial(w) for w in long) else 9
        return ("lossy", d) if d <= 1 else None
    best = matched(ca, cb)
    if best is None or best[1] > (MAX_EDITS if sum(map(len, ca)) >= 14 else 2):
        return None
    # an initial and a missing sector together count like three more edits: they only win where nothing else fits
    return ("lossy" if lossy or best[0] else "full", best[1] + 3 * (lossy and best[0] > 0))


#: What a pair of words that can't stand for each other costs, and what an initial does, in edits.
NEVER, INITIAL_COST = 10**6, 10**3


def matched(ca: list[str], cb: list[str]) -> tuple[int, int] | None:
    """(initials, edits) of the cheapest one-to-one pairing of the words in any order, fewest initials first; None where none will do.

    One pair at least must be of whole words that aren't both given names.
    """

    def cost(x: str, y: str) -> int:
        if is_initial(x) != is_initial(y):
            return INITIAL_COST if x[0] == y[0] else NEVER
        d = token_edits(x, y)
        return d if d <= MAX_EDITS else NEVER

    table = [[cost(x, y) for y in cb] for x in ca]
    telling = [(i, j) for i, x in enumerate(ca) for j, y in enumerate(cb) if not is_initial(x) and not is_initial(y) and not (is_given(x) and is_given(y)) and table[i][j] < NEVER]
    best = None
    for pairs in ([cheapest(table)] if len(ca) > 1 else [[0]]):
        if not any((i, j) in set(telling) for i, j in enumerate(pairs)):
            # the cheapest pairing has no telling pair: the cheapest with each one fixed
            tries = [[*p[:i], j, *p[i:]] for i, j in telling for p in [[k + (k >= j) for k in cheapest([[c for y, c in enumerate(row) if y != j] for x, row in enumerate(table) if x != i])]]]
        else:
            tries = [pairs]
        for t in tries:
            total = sum(table[i][j] for i, j in enumerate(t))
            if total < NEVER and total % INITIAL_COST <= MAX_EDITS and (best is None or total < best):
                best = total
    return None if best is None else divmod(best, INITIAL_COST)


def cheapest(table: list[list[int]]) -> list[int]:
    """The column of each row in the one-to-one assignment with the least sum (shortest augmenting paths)."""
    n = len(table)
    u, v, row_of = [0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
    for i in range(1, n + 1):
        row_of[0], j, way, least, used = i, 0, [0] * (n + 1), [float("inf")] * (n + 1), [False] * (n + 1)
        while row_of[j]:
            used[j], r, nearest, step = True, row_of[j], 0, float("inf")
            for k in range(1, n + 1):
                if not used[k]:
                    d = table[r - 1][k - 1] - u[r] - v[k]
                    if d < least[k]:
                        least[k], way[k] = d, j
                    if least[k] < step:
                        step, nearest = least[k], k
            for k in range(n + 1):
                if used[k]:
                    u[row_of[k]] += step
                    v[k] -= step
                else:
                    least[k] -= step
            j = nearest
        while j:
            row_of[j] = row_of[way[j]]
            j = way[j]
    out = [0] * n
    for j in range(1, n + 1):
        out[row_of[j] - 1] = j - 1
    return out


def _joined(ca: list[str], cb: list[str]) -> tuple[str, int] | None:
    """Names whose words are run together or torn apart."""
    d = edits("".join(ca), "".join(cb), 2)
    return ("full", d) if d <= 2 and min(sum(map(len, ca)), sum(map(len, cb))) >= 8 else None


def one_deleted(word: str, two: bool) -> set[str]:
    once = {word[:i] + word[i + 1 :] for i in range(len(word))}
    return {word, *once, *({w[:i] + w[i + 1 :] for w in once for i in range(len(w))} if two else ())}


LONG = 24


def deletion_forms(word: str, two: bool) -> set[str]:
    """Texts of which words within two edits (one, if not `two`) share at least one.

    Short words: what is left without some letters. Words of more than LONG letters, where that grows
    too much: eight letters from the start, the end and around the middle; two edits can't spoil all.
    """
    if len(word) <= LONG:
        return one_deleted(word, two) | ({word[:8] + "<", ">" + word[-8:]} if len(word) >= LONG - 2 else set())
    mid = len(word) // 2 - 4
    return {word[:8] + "<", ">" + word[-8:], *(f"={word[mid + i : mid + i + 8]}" for i in range(-3, 4))}


def rewritings(core: list[str]) -> set[str]:
    """The keys under which a name can meet another: each telling word without some letters, with the first letter of the word beside it.

    The word beside may be gone (`*`) where it is a given name or initial, and the words may be run together.
    """
    out = set()
    for i, w in enumerate(core):
        if is_initial(w) or (is_given(w) and len(core) > 1):
            continue
        rest = core[:i] + core[i + 1 :]
        marks = {"".join(sorted(r[0] for r in rest)) if rest else "*"}
        if len(rest) == 1 and (is_given(rest[0]) or is_initial(rest[0])):
            marks.add("*")
        out |= {f"{d}|{m}" for d in (deletion_forms(w, len(w) >= 7) if len(w) > 2 else {w}) for m in marks}
    if len(core) != 1:
        out |= {f"{d}|*" for d in deletion_forms("".join(core), False)}
    return out


def _parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        got = [parse(c) for c in pdf.company]
        yield pd.DataFrame({"company": pdf.company, "key": [" ".join(sorted(c)) + "|" + s for c, s in got], "core": [c for c, _ in got], "sector": [s for _, s in got]})


def _exploded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = [(f, k) for k, core in zip(pdf.key, pdf.core, strict=True) for f in sorted(rewritings(list(core)))]
        yield pd.DataFrame(rows, columns=["form", "key"])


def _compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    split = lambda key: (key.rpartition("|")[0].split(" "), key.rpartition("|")[2])
    for pdf in batches:
        rows = [(a, b, n, *c) for a, b, n in zip(pdf.a, pdf.b, pdf.shared_by, strict=True) if (c := compare(split(a), split(b)))]
        yield pd.DataFrame(rows, columns=["a", "b", "shared_by", "how", "edits"])


def link_names(rows: DataFrame, column: str = "company") -> DataFrame:
    """(company, entity): each distinct non-null spelling with the entity it belongs to.

    Every distinct spelling is rewritten into a canonical key; only distinct keys go on. A key's
    rewritings (words without some letters, initials, missing parts) are exploded and equi-joined;
    what meets is compared. Full matches make components. A key that a lossy rewriting leads to others
    (initial, missing sector or given name) joins them only if that rewriting is rare: all its partners
    lie in one entity; if they lie in several, it stays apart, as do names without letters. Of several
    entities those with the fewest edits count, among these those met by the rewriting that the fewest keys share. Spellings, not rows, are joined, so a name that a third
    of all rows bear is one spelling.

    Empty and blank spellings are each their own entity. Empty tables give an empty result.
    """
    names = rows.where(F.col(column).isNotNull()).select(F.col(column).alias("company")).distinct()
    parsed = checkpoint(spread(names).mapInPandas(_parsed, "company string, key string, core array<string>, sector string"))
    keys = parsed.groupBy("key").agg(F.first("core").alias("core")).where(F.col("key").rlike(r"[^|\s]"))
    forms = checkpoint(spread(keys).mapInPandas(_exploded, "form string, key string"))
    left, right = forms.withColumnRenamed("key", "a"), forms.withColumnRenamed("key", "b")
    # a rewriting tells the more the fewer keys share it; a pair counts with the rarest it shares
    spread_of = forms.groupBy("form").agg(F.count("*").alias("shared_by")).where("shared_by > 1")
    left = left.join(spread_of, "form")
    pairs = left.join(right, "form").where("a < b").groupBy("a", "b").agg(F.min("shared_by").alias("shared_by"))
    links = checkpoint(spread(pairs).mapInPandas(_compared, "a string, b string, shared_by bigint, how string, edits int"))
    whole = components(links.where("how = 'full'"))
    entity = keys.select("key").join(whole.withColumnRenamed("node", "key"), "key", "left").select("key", F.coalesce("root", "key").alias("entity"))
    entity = checkpoint(entity)

    # lossy links between entities: the entity with less said joins the one that says more, if that one is alone
    lossy = links.where("how = 'lossy'")
    score = F.struct("edits", "shared_by").alias("score")
    both = lossy.select("a", "b", score).union(lossy.select(F.col("b").alias("a"), F.col("a").alias("b"), score))
    told = F.length(F.regexp_replace("key", r"\b\w\b", ""))
    ends = both.join(entity.select(F.col("key").alias("a"), F.col("entity").alias("ea")), "a").join(entity.select(F.col("key").alias("b"), F.col("entity").alias("eb")), "b")
    size = entity.groupBy("entity").agg(F.max(told).alias("told"))
    ends = ends.where("ea <> eb").groupBy("ea", "eb").agg(F.min("score").alias("score"))
    ends = ends.join(size.select(F.col("entity").alias("ea"), F.col("told").alias("ta")), "ea").join(size.select(F.col("entity").alias("eb"), F.col("told").alias("tb")), "eb").where("ta < tb or (ta = tb and ea < eb)")
    least = ends.groupBy("ea").agg(F.min("score").alias("least"))
    near = checkpoint(ends.join(least, "ea").where("score = least"))
    # partners that are themselves only poorer spellings of another partner don't count as a second entity
    poorer = ends.select(F.col("ea").alias("eb"), F.col("eb").alias("ec"))
    led = near.join(poorer, "eb").join(near.select("ea", F.col("eb").alias("ec")), ["ea", "ec"]).select("ea", "eb").distinct()
    own = near.join(led, ["ea", "eb"], "left_anti").groupBy("ea").agg(F.count("*").alias("n"), F.min("eb").alias("eb"))
    merged = components(own.where("n = 1").select(F.col("ea").alias("a"), F.col("eb").alias("b")))
    final = entity.join(merged.withColumnRenamed("node", "entity"), "entity", "left").select("key", F.coalesce("root", "entity").alias("entity"))
    return parsed.join(final, "key", "left").select("company", F.coalesce("entity", F.concat(F.lit("="), "company")).alias("entity"))


def name_pairs(linked: DataFrame) -> DataFrame:
    """(company_a, company_b): all pairs of different spellings of one entity, the smaller first by code point."""
    a, b = linked.withColumnRenamed("company", "company_a"), linked.withColumnRenamed("company", "company_b")
    return a.join(b, "entity").where("company_a < company_b").select("company_a", "company_b")
