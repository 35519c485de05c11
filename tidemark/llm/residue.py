"""Unfilled templates, filler, error pages and script notices in place of real texts."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.simhash import RADIUS, block_keys, hamming, near, prefix, prefix_hashes, prefixes, shingles, simhash, word_hashes
from tidemark.runtime import checkpoint, spread

# Ways to write a slot of a template. The first kind is only used for slots, the second
# also for other things; it counts in sentences whose frame is known from the first.
STRONG_SLOT = (
    r"\{\{\s*[A-Za-z_]\w*(?:\.\w+)*\s*\}\}|\$\{\s*[A-Za-z_]\w*\s*\}|<%=?\s*[\w.]+\s*%>|@@\s*\w+\s*@@|\[INSERT [A-Z_ ]+\]|\[[\w ]+: to be completed\]"
    r"|\[\[field:\w+\]\]|%[A-Z][A-Z_]+%|\|\|[A-Z_]+\|\||\bXX[A-Z_]+XX\b|\{%\s*\w+\s*%\}|#\{\w+\}|(?<!\[)\[(?i:your|enter|add|insert) [\w ]+\](?!\])"
    r"|(?<![\[\w(])(?:\[(?!\[)|\{(?!\{)|<)(?i:(?:(?:first|last|full|company|client|customer|candidate|recipient|job|team|city|street|start|end|due|contact|hiring|manager|department|office|employer|salary|recruiter|product)[ _-]?(?:name|title|date|range|address|amount|role|e-?mail|phone|number|manager|location))|name|city|company|deadline|salary|position|department|date|amount|recipient)(?:\](?![\](])|\}(?!\})|>)"
)
WEAK_SLOT = r"\bundefined\b(?!-)|\bnull\b|\bNaN\b|\[object Object\]|\{\d\}|\{[a-z_]+\}|__[A-Z][A-Z_]+__|\[\[\w+\]\]|\[[A-Z_ ]{3,}\]|<[A-Z_ ]{3,}>|#[A-Z_]{3,}#|\[[a-z_ ]{3,}\]"
# A sentence with one of these speaks about templates.
TALK = r"(?i)\b(?:placeholders?|templates?|templating|jinja2?|handlebars|mustache|syntax|style)\b"
# Words of the usual dummy text, and sentences that stand for a text.
LOREM = set(
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud "
    "exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur "
    "excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum".split()
)
FILLERS = {"add job description here", "sample description replace before publishing", "sample description", "sample text", "dummy text", "content goes here", "text goes here", "placeholder paragraph number one", "description goes here", "your text here", "insert text here", "enter text here", "test test", "foo bar baz", "foo bar", "blah blah", "asdf qwer zxcv", "asdf asdf", "asdf"}
# Public texts that fill space, that stand for a page that failed and that ask for scripts.
SEEDS = (
    ("Cupcake ipsum dolor sit amet marshmallow topping. Chocolate bar tiramisu jelly beans candy canes gummi bears sweet roll. Caramels dessert lollipop toffee croissant macaroon.", "filler"),
    ("Bacon ipsum dolor amet short ribs brisket venison rump drumstick pig sausage prosciutto chicken spare ribs salami picanha doner.", "filler"),
    ("Far far away, behind the word mountains, far from the countries Vokalia and Consonantia, there live the blind texts. Separated they live in Bookmarksgrove right at the coast of the Semantics, a large language ocean.", "filler"),
    ("A wonderful serenity has taken possession of my entire soul, like these sweet mornings of spring which I enjoy with my whole heart.", "filler"),
    ("One morning, when Gregor Samsa woke from troubled dreams, he found himself transformed in his bed into a horrible vermin.", "filler"),
    ("The quick brown fox jumps over the lazy dog.", "filler"), ("Zwei flinke Boxer jagen die quirlige Eva und ihren Mops durch Sylt.", "filler"), ("Franz jagt im komplett verwahrlosten Taxi quer durch Bayern.", "filler"), ("Portez ce vieux whisky au juge blond qui fume.", "filler"),
    ("Li Europan lingues es membres del sam familie. Lor separat existentie es un myth.", "filler"), ("But I must explain to you how all this mistaken idea of denouncing pleasure and praising pain was born.", "filler"),
)
# What error pages and script notices say.
ERROR = re.compile(
    r"^\W*(?:error\W*)?(?:[45]00?\d\b|[45]\d\d\b).{0,40}(?:not found|error|gateway|denied|unavailable|forbidden|bad request|unauthorized|time-?out|too many)"
    r"|^\W*\{\W*error\b|page (?:could not|cannot|can.t) be found|(?:page|site|seite|página|page) (?:not found|nicht gefunden|no encontrada|introuvable)"
    r"|access denied|permission to (?:view|access)|session (?:has )?(?:expired|timed out)|too many requests|rate.limited|bad gateway|gateway time-?out"
    r"|service (?:is )?(?:temporarily )?unavailable|internal server error|something went wrong|traceback|hit a snag|cannot read propert|upstream host|no valid answer"
    r"|^\W*0\W+(?:not found|forbidden|bad request|unauthorized|internal server error|service unavailable|gone)\b|this (?:page|site) (?:isn.t|is not) (?:working|available)|unable to (?:service|process|complete) your request|requested url was not found|acceso denegado|accès refusé|zugriff verweigert|acesso negado|página não encontrada|ukurasa haukupatikana"
)
NOTICE = re.compile(
    r"(?:(?:enable|disabled?|turn(?:ed)? (?:it )?on|switch on|activate|activer|aktivieren|allow(?:ed)?|block(?:s|ed)?|requires?|without|needs?|must be|habilit\w+|activ\w+|ative|wezesha)\b[^.!?]*\b(?:javascript|java script|scripts?|scripting|active content))"
    r"|(?:(?:javascript|scripts?|scripting|active content)\b[^.!?]*\b(?:enabled?|disabled?|turn|switch|activate|aktivieren|activer|allow(?:ed)?|blocked|required|erforderlich|requis))"
    r"|(?:turn|switch)\b[^.!?]{0,40}\b(?:javascript|scripts?|scripting)\b[^.!?]{0,20}\bon\b|^loading\b.*\ballow\b"
)
#: A text with neither of these words is no error page or notice.
PAGE_WORDS = frozenset("javascript script scripts scripting active error fehler erreur found gefunden encontrada introuvable haukupatikana denied denegado refusé verweigert negado permission expired timed requests limited gateway unavailable wrong traceback snag properties upstream answer forbidden unauthorized unable isn page site url gone".split())
# What the sentences beside them are about, and words of any sentence.
SERVICE = frozenset(
    "page pages site website web server servers request requests requested url urls link address browser browsers settings support administrator admin webmaster error errors code reference trace id ray incident second seconds minute minutes moment later again back soon maintenance downtime capacity overload overloaded temporarily temporary log login logged sign session "
    "expired continue home homepage network connection timeout timed gateway proxy host origin upstream cache cookie cookies javascript script scripts scripting enabled enable disabled checking check before accessing access security redirected redirect automatic automatically process protection ddos cloudflare nginx apache ubuntu port powered try retry reload refresh problem persists contact "
    "please wait return went wrong sorry inconvenience apologize apologise oops resource resources permission load loading loaded click button view display shown show appears visit visiting verify verifying human bot captcha version update content blocked status internal respond response technical team notified working resolve soonest fix "
    "seite adresse aufgerufene gefunden fehler anfrage später erneut versuchen zugriff wartung browser einstellungen página enlace funciona código seguido solicitud intente intenta nuevo tarde mantenimiento navegador lien demandée serveur réessayer réessayez tard navigateur ligação pedido tente novamente navegador ukurasa kiungo jaribu tena baadaye seva kivinjari".split()
)
PLAIN_WORDS = frozenset("the a an of to in on at by for from with and or if it is are was be been this that we you your our have has had not no do does can could will would may might must should as but so then there here what when which who i my me us they them their its than too very just only also any all some more take took takes go went out up down due while how why die der das den es nicht gibt ist und sie wir bitte ein eine zu el la los las que has no de en un una se por le les des du est pas vous nous ce cette o os as não em um uma na ya kwa hakuna".split())
COMMON_LONG = frozenset("chocolate chicken separated language countries mountains wonderful mornings morning possession himself troubled transformed explain mistaken pleasure praising komplett dessert denouncing semantics familie membres quirlige whiskey through".split())
#: Of a sentence that matches one of the patterns so many words count at most as a page's talk.
MATCH_WORDS = 25
#: The share of a text's words that has to be such talk.
PAGE_SHARE = 0.7
WORD = re.compile(r"[^\W_]+|§")
BLOCK = re.compile(r"</?(?:p|div|li|ul|ol|h[1-6]|br|hr|tr|td|th|table|tbody|thead|blockquote|section|article|header|footer|main|dl|dt|dd|noscript)\b[^>]*>", re.I)
TAG = re.compile(r"</?[a-zA-Z][^<>]*>")
HIDDEN = re.compile(r"<!--.*?-->|<(script|style|pre|code|syntaxhighlight|source|math|template)\b.*?</\1\s*>", re.I | re.S)
FENCED = re.compile(r"^[ \t]*(```|~~~).*?(?:^[ \t]*\1|\Z)|`[^`\n]+`", re.M | re.S)
TEX = re.compile(r"\\begin\{(verbatim|lstlisting|equation|align|displaymath|minted)\*?\}.*?\\end\{\1\*?\}|\\\[.*?\\\]|\\\(.*?\\\)", re.S)
DISPLAY = re.compile(r"\$\$.*?\$\$", re.S)
COMMAND = re.compile(r"\\(?:begin|end)\{[^}]*\}(?:\[[^\]]*\])?|\\(?:item|noindent|par|maketitle|textbf|emph|textit|texttt|href\{[^}]*\}|(?:sub)*section\*?)(?![a-zA-Z])|\\(?=[{}_%$&#])")
ARGUMENT = re.compile(r"\\(?:textbf|emph|textit|texttt|underline|href\{[^}]*\}|(?:sub)*section\*?)\{([^{}]*)\}")
LINK = re.compile(r"\[([^\[\]]*)\]\([^()\s]*\)")
EMPHASIS, LEAD = re.compile(r"\*+|'{2,}"), re.compile(r"[ \t]*(?:[-+•#=]+|\d+[.)])[ \t]+")
SPACE, SPACE_RUNS = re.compile(r"\s+"), re.compile(r"[^\S\n]+")
SLOT = re.compile(f"{STRONG_SLOT}|{WEAK_SLOT}")
STRONG, TALKS = re.compile(STRONG_SLOT), re.compile(TALK)
NUMBER, TRACE = re.compile(r"\d+"), re.compile(r"\b(?=[a-f]*\d)[0-9a-f]+\b|\d+", re.I)
#: Without one of these TRACE finds what NUMBER finds.
TRACE_MARKS = re.compile(r"\d[a-fA-F]|[a-fA-F]\d")
SENTENCE = re.compile(r"(?<=[.!?])\s+")
ASKED = re.compile(r"Please enable JavaScript to see [\w ]+\.$")
#: Any text with a slot has one of these in it.
SLOT_MARKS = re.compile(r"[{<\[%|#]|@@|XX|__|undefined|null|NaN")


def readable(text: str) -> list[str]:
    """The paragraphs that readers see, without markup, code, formulas and scripts."""
    if "&lt;" in text and not TAG.search(text):
        text = html.unescape(text)
    if "<" in text:
        text = HIDDEN.sub(" ", text)
    if "```" in text or "~~~" in text or "`" in text:
        text = FENCED.sub(" ", text)
    if "\\" in text:
        text = COMMAND.sub("", ARGUMENT.sub(r"\1", TEX.sub(" ", text)))
    if "$$" in text:
        text = DISPLAY.sub(" ", text)
    if "<" in text:
        text = TAG.sub("", BLOCK.sub("\n", text))
    if "&" in text:
        text = html.unescape(text)
    if "](" in text:
        text = LINK.sub(r"\1", text)
    out = []
    for line in text.split("\n"):
        if lead := LEAD.match(line):
            line = line[lead.end() :]
        if "*" in line or "''" in line:
            line = EMPHASIS.sub("", line)
        if line := " ".join(line.split()):
            out.append(line)
    return out


def frame(text: str, numbers: re.Pattern = NUMBER) -> str:
    """Lower case, slots and numbers masked, so that what a template makes of different values is one text."""
    if SLOT_MARKS.search(text):
        text = SLOT.sub("§", text)
    if NUMBER.search(text):
        text = numbers.sub("0", text)
    return SPACE.sub(" ", text.lower()).strip()


def _cycle(words: list[str]) -> bool:
    """Whether the text is one phrase of up to five words again and again."""
    return any(len(words) >= max(3, 2 * p) and all(words[i] == words[i - p] for i in range(p, len(words))) for p in range(1, 6))


def about_the_page(words: list[str]) -> bool:
    """Whether a sentence only speaks about a page, a server or a browser."""
    known = sum(w in SERVICE for w in words)
    return known >= (1 if len(words) <= 4 else 2) and known + sum(w in PLAIN_WORDS or w == "0" for w in words) >= 0.7 * len(words)


def page_kind(paragraphs: list[str]) -> str | None:
    """`error_page` or `script_notice` for a text, however long, that says so and little else.

    A sentence that matches ERROR or NOTICE counts with MATCH_WORDS words at most, one that only
    speaks about pages, servers and browsers in full; they must make PAGE_SHARE of all words.
    """
    found, talk, total = set(), 0, 0
    for p in paragraphs:
        for s in SENTENCE.split(p):
            words = WORD.findall(s)
            total += len(words)
            kind = "error_page" if ERROR.search(s) else "script_notice" if NOTICE.search(s) else None
            if kind:
                found.add(kind)
                talk += min(len(words), MATCH_WORDS)
            elif about_the_page(words):
                talk += len(words)
    return min(found) if found and talk >= PAGE_SHARE * total else None


def filler_of(words: list[str]) -> tuple[bool, bool]:
    """Whether a paragraph is filler beyond doubt, and whether it can be a near-duplicate of some.

    Beyond doubt are phrases of FILLERS, a phrase again and again, and five words or more of which
    seven tenths are dummy words. A near-duplicate has three tenths dummy words (a text that shares
    eight tenths of its shingles with seven tenths dummy words has more), a word that only SEEDS
    use, or few shingles because words repeat (one that shares them with a repeated phrase, which has
    five shingles at most, has six at most).
    """
    distinct = len(set(words))
    known = sum(map(LOREM.__contains__, words))
    if known >= 0.7 * len(words) and len(words) >= 5 or distinct <= 5 and _cycle(words) or " ".join(words) in FILLERS:
        return True, True
    if distinct < len(words) and (len(words) <= 12 or distinct <= 12) and len(shingles(words)) <= 8:
        return False, True
    return False, not seed_words().isdisjoint(words) or len(words) >= 4 and known >= 0.3 * len(words)


@lru_cache(1)
def seed_words() -> frozenset[str]:
    """The longer words of the filler among SEEDS, of which any near-duplicate keeps some."""
    return frozenset(w for text, kind in SEEDS if kind == "filler" for w in WORD.findall(text.lower()) if len(w) >= 7) - LOREM - COMMON_LONG


def seed_units(text: str, kind: str) -> list[tuple[str, str, str]]:
    return [("paragraph", frame(text), kind)]


#: Paragraphs of fewer words have too few shingles to be near any other words than the same.
LEAST_WORDS = 8


class Piece(NamedTuple):
    """A paragraph: as a unit, with the hashes of its words, and as a part of the whole text; what it looks like."""

    unit: str
    hashes: np.ndarray
    part: str
    part_hashes: np.ndarray
    filler: bool
    maybe: bool
    page: bool
    sentences: tuple[tuple[str, str | None], ...]


def _piece(p: str) -> Piece:
    has = bool(SLOT_MARKS.search(p)) and bool(SLOT.search(p))
    masked = SLOT.sub("§", p) if has else p
    unit = NUMBER.sub("0", masked).lower()
    if has:
        unit = SPACE_RUNS.sub(" ", unit).strip()
    words = WORD.findall(unit)
    hashes = part_hashes = word_hashes(words)
    part = unit
    if "Please enable" in p or TRACE_MARKS.search(masked):
        q = ASKED.sub("", p).strip() if "Please enable" in p else p
        part = frame(q, TRACE) if q else ""
        if part != unit:
            part_hashes = word_hashes(WORD.findall(part))
    page = not PAGE_WORDS.isdisjoint(words) and bool(ERROR.search(unit) or NOTICE.search(unit))
    slotted = tuple((frame(s), "placeholder" if STRONG.search(s) else None) for s in SENTENCE.split(p) if SLOT.search(s) and not TALKS.search(s)) if has else ()
    return Piece(unit, hashes, part, part_hashes, *filler_of(words), page, slotted)


_kept_piece = lru_cache(1 << 15)(_piece)
#: Longer paragraphs aren't kept for when they come again.
KEPT_CHARS = 1000


def look(text: str) -> tuple[list[Piece], dict[tuple[str, str], str | None], bool]:
    """The paragraphs of a text, (scope, unit): trusted kind for what of it looks like residue, and whether the whole does."""
    paragraphs = readable(text)
    pieces = [_kept_piece(p) if len(p) <= KEPT_CHARS else _piece(p) for p in paragraphs]
    likely, page = {}, False
    for x in pieces:
        page = page or x.page
        if x.maybe:
            likely["paragraph", x.unit] = "filler" if x.filler else None
        for unit, kind in x.sentences:
            likely["sentence", unit] = kind or likely.get(("sentence", unit))
    if page:
        parts = [x.part for x in pieces if x.part] or [frame(" ".join(paragraphs), TRACE)]
        likely["whole", " ".join(parts)] = page_kind(parts)
    return pieces, likely, page


def units_of(text: str) -> list[tuple[str, str, str | None, bool]]:
    """(scope, unit, trusted kind, likely): what of a text is, or can be near, residue.

    Any paragraph and any whole text can, also through others; those that look like it are likely.
    A sentence without a slot is no unfilled one however near it is.
    """
    pieces, likely, page = look(text)
    others = dict.fromkeys(("paragraph", x.unit) for x in pieces if not x.maybe and len(x.hashes) >= LEAST_WORDS)
    if pieces and not page:
        others["whole", " ".join(x.part for x in pieces if x.part) or frame(" ".join(readable(text)), TRACE)] = None
    return [(scope, unit, kind, True) for (scope, unit), kind in likely.items()] + [(scope, unit, None, False) for scope, unit in others]


#: Words whose marks are made at once.
WORDS_AT_ONCE = 1 << 19


class Marks:
    """The marks of texts' units that don't look like residue, made for many texts at once."""

    def __init__(self):
        self.hashes, self.n, self.starts, self.lengths, self.whole, self.rows = [], 0, [], [], [], []

    def add(self, row: int, pieces: list[Piece], page: bool) -> None:
        """A paragraph's words are a run of the whole text's, unless traces make them differ."""
        seen, before, apart = set(), len(self.starts), []
        begin = self.n
        for x in pieces:
            if not x.maybe and len(x.hashes) >= LEAST_WORDS and x.unit not in seen:
                seen.add(x.unit)
                if x.part_hashes is x.hashes:
                    self._run(self.n, len(x.hashes), False)
                else:
                    apart.append(x.hashes)
            self._words(x.part_hashes)
        if not page and self.n > begin:
            self._run(begin, self.n - begin, True)
        for hashes in apart:
            self._run(self.n, len(hashes), False)
            self._words(hashes)
        if len(self.starts) > before:
            self.rows.append((row, len(self.starts) - before))

    def _words(self, hashes: np.ndarray) -> None:
        self.hashes.append(hashes)
        self.n += len(hashes)

    def _run(self, start: int, length: int, whole: bool) -> None:
        self.starts.append(start)
        self.lengths.append(length)
        self.whole.append(whole)

    def take(self) -> list[tuple[int, None, None, None, np.ndarray]]:
        """(row, None, None, None, marks) of the texts since the last call."""
        if not self.rows:
            self.__init__()
            return []
        marks, counts = prefixes(np.concatenate(self.hashes), np.array(self.starts), np.array(self.lengths))
        marks = np.where(np.repeat(np.array(self.whole), counts), ~marks, marks)
        ends = np.cumsum(counts)[np.cumsum([n for _, n in self.rows]) - 1]
        out = [(row, None, None, None, m) for (row, _), m in zip(self.rows, np.split(marks, ends[:-1]), strict=True)]
        self.__init__()
        return out


def marks_of(scope: str, unit: str) -> list[int]:
    """The hashes of which near units of the scope share one."""
    marks = prefix_hashes(WORD.findall(unit))
    return marks if scope == "paragraph" else [~h for h in marks]


#: Marks, and ids of texts to be read again, that are sent to every task at most; more of them are joined by a shuffle.
SENT_MARKS = 1_000_000


def _grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        words = [WORD.findall(t) for t in pdf.unit]
        yield pdf.assign(fp=[simhash(w) for w in words], grams=[shingles(w) for w in words])


def candidates(frontier: DataFrame, rest: DataFrame) -> DataFrame:
    """(scope, unit, kind, l_grams): the units of `rest` that may be near-duplicates of labelled ones.

    From the partitioned SimHash tables come those within RADIUS bits. Short texts of the same
    similarity lie further apart (a word more or less moves a text of a dozen words by some eight bits), so
    for what the tables can't guarantee the prefixes of the shingles are joined as well, which find
    every pair of the similarity.
    """
    f, r = frontier.select("scope", "kind", F.col("fp").alias("l_fp"), F.col("grams").alias("l_grams")), rest.select("scope", "unit", "fp", "grams")
    tables = f.withColumn("b", F.explode(block_keys(F.col("l_fp")))).join(r.withColumn("b", F.explode(block_keys(F.col("fp")))).drop("grams"), ["scope", "b"])
    tables = tables.where(hamming(F.col("fp"), F.col("l_fp")) <= RADIUS).select("scope", "unit", "kind", "l_grams")
    prefixes = f.select("scope", "kind", "l_grams", F.explode(prefix(F.col("l_grams"))).alias("key")).join(r.select("scope", "unit", F.explode(prefix(F.col("grams"))).alias("key")), ["scope", "key"])
    return tables.unionByName(prefixes.select("scope", "unit", "kind", "l_grams"))


def propagate(units: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(scope, unit, kind): the trusted labels and all units in their components of near-duplicates.

    `units` has distinct (scope, unit) with fp, grams and kind, null where not trusted. Each round
    looks for near-duplicates of the newly labelled units (`candidates`) and accepts those whose
    shingles reach the similarity, so components without a trusted label are never built, nor pairs of unlabelled units. Of two
    labels that reach a unit in one round the smaller name wins. The rounds end when nothing is new; if
    that takes more than `max_rounds` an error is raised rather than a partial answer given.
    """
    cut = checkpoint(units)
    done = cut.where("kind is not null").select("scope", "unit", "kind")
    frontier, rest = cut.where("kind is not null"), cut.where("kind is null").drop("kind")
    for _ in range(max_rounds):
        hits = candidates(frontier, rest).join(rest.select("scope", "unit", "fp", "grams"), ["scope", "unit"]).where(near(F.col("grams"), F.col("l_grams")))
        new = checkpoint(hits.groupBy("scope", "unit").agg(F.min("kind").alias("kind"), F.first("fp").alias("fp"), F.first("grams").alias("grams")))
        if new.isEmpty():
            return done
        done = done.unionByName(new.select("scope", "unit", "kind"))
        rest = rest.join(new.select("scope", "unit"), ["scope", "unit"], "left_anti")
        frontier = new
    raise RuntimeError(f"labels did not settle within {max_rounds} rounds")


def find_residue(rows: DataFrame, text_col: str = "description_html") -> DataFrame:
    """(row_id, kind): rows whose text is no finished text, a row for each kind found.

    The readable text is cut into units: the whole text, its paragraphs, and its sentences that hold
    something like a slot. Units that are equal up to numbers and slots are one. Those that look like
    residue (`page_kind`, `filler_of`) are kept from the start, of all others only the marks that near
    units share: texts that share one with a labelled unit are read again, until no label is new.
    Trusted are slots in unmistakable syntax outside code and talk about templates, dummy words and
    phrases repeated over and over, whole pages, and the public texts of SEEDS. From there the labels go on
    through components of near-duplicates (`propagate`). An error page or notice is only one as a whole.

    Null and empty texts give no row; repeated rows are found again under their ids; other columns
    don't matter; an empty table gives an empty result.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            flat, marks = [], Marks()
            for i, text in zip(pdf.row_id, pdf[text_col], strict=True):
                pieces, likely, page = look(text)
                flat += [(i, scope, unit, kind, None) for (scope, unit), kind in likely.items()]
                marks.add(i, pieces, page)
                if marks.n >= WORDS_AT_ONCE:
                    flat += marks.take()
            flat += marks.take()
            yield pd.DataFrame(flat, columns=["row_id", "scope", "unit", "kind", "marks"]).astype({"row_id": "int64", "scope": object, "unit": object, "kind": object, "marks": object})

    def others(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            flat = [(i, *u[:3]) for i, text in zip(pdf.row_id, pdf[text_col], strict=True) for u in units_of(text) if not u[3]]
            yield pd.DataFrame(flat, columns=["row_id", "scope", "unit", "kind"]).astype({"row_id": "int64", "kind": object})

    def marks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"mark": pd.Series([m for scope, unit in zip(pdf.scope, pdf.unit, strict=True) for m in marks_of(scope, unit)], dtype="int64")})

    sent = lambda df: F.broadcast(df) if df.count() <= SENT_MARKS else df
    kept = rows.where(F.col(text_col).isNotNull() & (F.col(text_col) != "") & F.col("row_id").isNotNull()).select(F.col("row_id").cast("bigint").alias("row_id"), text_col)
    flat = checkpoint(spread(kept).mapInPandas(run, "row_id bigint, scope string, unit string, kind string, marks array<bigint>"))
    seeds = flat.sparkSession.createDataFrame([(scope, unit, kind) for text, kind in SEEDS for scope, unit, _ in seed_units(text, kind)], "scope string, unit string, kind string")
    links, marked, known = flat.where("scope is not null").drop("marks"), flat.where("scope is null").select("row_id", F.explode("marks").alias("mark")), 0
    while True:
        distinct = links.select("scope", "unit", "kind").unionByName(seeds).groupBy("scope", "unit").agg(F.max("kind").alias("kind"))
        labelled = propagate(distinct.mapInPandas(_grams, "scope string, unit string, kind string, fp bigint, grams array<string>"))
        before, known = known, labelled.count()
        if known == before:  # what was read last brought no label that others could be near to
            break
        wanted = checkpoint(labelled.where("scope <> 'sentence'").select("scope", "unit").mapInPandas(marks, "mark bigint").distinct())
        near_rows = checkpoint(marked.join(sent(wanted), "mark", "left_semi").select("row_id").distinct())
        links = flat.where("scope is not null").drop("marks").unionByName(checkpoint(kept.join(sent(near_rows), "row_id", "left_semi").mapInPandas(others, "row_id bigint, scope string, unit string, kind string")))
    return links.select("row_id", "scope", "unit").join(labelled, ["scope", "unit"]).select("row_id", "kind").distinct()
