"""Personal information in free text: span generators, boosted trees, calibrated thresholds.

Generators with high recall propose overlapping spans of each kind; boosted trees judge them by format
and context; thresholds set on held-out rows select. The trees are trained on sentences written from
the frames below: at most TRAINING_SENTENCES, drawn by a fixed seed, a bounded sample by design. The
frames are general; none is taken from the texts the operator is run on.
"""

from __future__ import annotations

import base64
import random
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.boost import Boost, best_threshold
from tidemark.runtime import spread

KINDS = ("email", "phone", "id_number", "address", "person")
TRAINING_SENTENCES = 14_000

#: A public tokenizer's vocabulary, of which the words in lower case serve as the common words.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Given names that people in the corpus's regions bear.
GIVEN = set(
    "achieng aisha akinyi alejandro alice amara amina ana anders andrea anna antonio baraka beatriz brigid carlos carmen chidi chloe clara claire daniel david desta diego edith elena elizabeth emeka emil emma eva "
    "farida fatima felix francisco gabriel gabriela grace halima hamish hanna hanne hassan helena henrik ibrahim ines ingrid isabel jakob james jan jane joana joao john jonas jose juan juma julia kamau karim katarina "
    "kofi kwame lars laura leila lena lotte louise luca lucia lukas luis maria marek marie mario marta martin mary maria mateus matteo mercy michael miguel mirela mohammed moses mwangi nadia ngozi nia nikolai njeri noah "
    "odile olek oliver olivia omar otieno pascal paul pedro peter petra pierre priya rahul rania rashid ravi robert rosa ruth samuel sara sarah signe sofia sophie stefan sunita susanna sven teodor teresa thomas tomas viktor wambui "
    "wangari wanjiru wei yara yusuf zainab zuri christopher benjamin abigail edward william".split()
)
# Endings that are common in family names.
ENDINGS = ("ius", "eko", "ova", "ez", "sen", "ström", "strom", "wick", "omba", "ell", "ard", "ing", "ani", "son", "ski", "sky", "ska", "ov", "ev", "eva", "escu", "enko", "mann", "berg", "stein", "ini", "elli", "idis", "ian", "oglu", "wala", "kar", "ani", "ho", "aga", "oti", "uki", "ndo")
# Words that are never part of a person's name.
STOP = set(
    "the a an and or of for to in on at by with from as is are was were be been am i you he she it we they my your his her our their this that these those not no if when who which what how why where there here than then "
    "before after about into over under near off per via all any each every some more most less only also still yet very please thank thanks dear regards kind best sincerely yours hello hi mr mrs ms dr prof sir madam "
    "call phone tel telefon telephone simu mobile fax mail email write contact kontakt ask reference interviewer recruiter badge request reporting line number passport national id tax pin ssn social security insurance nif no "
    "monday tuesday wednesday thursday friday saturday sunday january february march april may june july august september october november december starts team rated task signed form lead took reachable noon "
    "na kwa ya wa za la cha ni katika kama au hii hiyo wasiliana und oder der die das ist im am zu zur zum mit von für bei auf ein eine wir sie ihr de la le les des du et ou est en un une au aux vous nous pour par sur avec que qui "
    "el los las del al y o es por con para una su se lo ao da do dos das e em os as um uma à não pregunte escriba llame joindre merci envie contrato cuidado ansprechpartner plot flat house box street road lane close drive avenue ave "
    "ltd inc llc gmbh group brothers company co saint station office city town python java sql go rust kotlin engineer remote full time sent posted copy applied twice year moved kept candidate gave payroll needs api apis between mention score share bring tried node host ujuzi dein deine unser unsere büro gute guter gutes meine mein finish nobody background check hold "
    "would could should will can may might must shall have has had do does did".split()
) - {"wa", "de", "la", "da", "may", "april", "june", "august"}
STOP_WORDS = frozenset(w for w in STOP if len(w) > 1)
STREET_WORDS = "Street|St\\.?|Road|Rd\\.?|Lane|Ln\\.?|Close|Drive|Dr\\.?|Avenue|Ave\\.?|Court|Ct\\.?|Way|Crescent|Gardens|Place|Terrace|Highway|Boulevard|Blvd\\.?|Square|Hill|Row|Walk|Grove|Park"
U, L = "A-ZÀ-ÖØ-ÞĀĂĄĆČĎĐĒĖĘĚŁŃŇŐŒŘŚŞŠŢŤŪŮŰŹŻŽ", "a-zà-öø-ÿāăąćčďđēėęěłńňőœřśşšţťūůűźżž"
NAME = rf"[{U}{L}]+(?:['’][{U}{L}]+)*(?:-[{U}{L}]+(?:['’][{U}{L}]+)*)*"
TOWN = rf"[{U}][{U}{L}'’-]+"
AT = r"(?:\s?(?:@|＠|&#64;|\(at\)|\[at\]|\{at\}|\(a\)|<at>)\s?|\s(?:at|AT|arobase)\s)"
DOT = r"(?:\.|\s?(?:\(dot\)|\[dot\]|\{dot\}|<dot>)\s?|\s(?:dot|DOT|point)\s)"
EMAIL = re.compile(rf"(?<![\w.+%-])[\w+%-]+(?:\.[\w+%-]+)*{AT}[A-Za-z0-9-]+(?:{DOT}[A-Za-z0-9-]+)*{DOT}[A-Za-z]{{2,}}(?![\w-])", re.I)
PHONE = re.compile(r"(?<![\w./-])(?:\+|00)?\(?\d[\d() ./-]{5,20}\d(?:\s?(?:ext\.?|x|extension|Durchwahl|poste)\s?\d{1,5})?(?![\w@])", re.I)
PHONE_FORMS = [
    re.compile(p + r"(?:\s?(?:ext\.?|x|extension)\s?\d{1,5})?(?![\w@]|[.-]\d)")
    for p in (
        r"(?:\+|00)\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,5}(?:[ .-]?\d{2,8}){1,5}", r"\(0\d{1,4}\)[ .-]?\d{3,5}(?:[ .-]?\d{3,4}){1,2}", r"0\d{1,4}(?:[ .-]\d{3,8}){1,3}", r"0\d(?:[ .-]\d{2}){4}",
        r"(?:1[ .-])?\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}", r"0\d{8,11}", r"[2-9]\d{2}[ .-]\d{4}",
    )
]
IDS = [re.compile(p) for p in (
    r"\b[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-D]\b", r"(?<![\w-])\d{3}[- ]\d{2}[- ]\d{4}(?![\w-])", r"\b[A-Z]\d{9}[A-Z]\b", r"(?<![\w-])\d{8}-?[A-Z]\b", r"\b[A-Z]\d{2}[A-Z]\d{4,6}\b", r"\b[CFGHJKLMNPRTVWXYZ](?=[A-Z]*\d[A-Z]*\d)[CFGHJKLMNPRTVWXYZ0-9]{8}\d?\b", r"\b[A-Z]{1,3}\d{6,9}\b",
    r"(?<![\w+.-])\d{4} \d{4}(?![\w-]| \d)", r"(?<![\w+./-])\d{7,11}(?![\w-]|\.\d)", r"(?<![\w-])\d{3}\.\d{3}\.\d{3}-\d{2}\b", r"(?<![\w+])[12] ?\d{2} ?\d{2} ?\d{2} ?\d{3} ?\d{3}(?: ?\d{2})?\b",
)]
ADDRESSES = [re.compile(p) for p in (
    rf"\bP\.? ?O\.? ?Box \d+(?:[ -]\d+)?, {TOWN}", rf"\b(?:Plot|House|Hse|Flat|Apartment|Apt|Unit|Suite|Block)\.?(?: No\.?)? \d+[A-Za-z]?, (?:\d+[A-Za-z]? )?{TOWN}(?: {TOWN})*? (?:{STREET_WORDS})(?:, off {TOWN}(?: {TOWN})*? (?:{STREET_WORDS}))?, {TOWN}(?: [A-Z]{{1,2}}\d[A-Z\d]? \d[A-Z]{{2}}\b)?",
    rf"(?<![\w,.-])\d{{1,5}}[A-Za-z]? {TOWN}(?: {TOWN})*? (?:{STREET_WORDS})(?: (?:NW|NE|SW|SE|N\.?|S\.?|E\.?|W\.?))?(?:,? (?:Apt|Suite|Unit|Flat|#)\.? ?\w+)?, {TOWN}(?:,? [A-Z]{{2}} \d{{5}}(?:-\d{{4}})?| [A-Z]{{1,2}}\d[A-Z\d]? \d[A-Z]{{2}}\b)?",
    rf"\b{TOWN}(?:straße|strasse|str\.|weg|gasse|platz|allee|ring|damm|ufer) \d+ ?[a-z]?, \d{{5}} {TOWN}", rf"(?<![\w,.-])\d{{1,4}}(?: ?(?:bis|ter))?,? (?:rue|avenue|boulevard|place|chemin|impasse|allée|quai|route|Rue|Avenue|Boulevard) (?:(?:de|du|des|de la|de l['’]|la|le|d['’])\s?)*{TOWN}(?: {TOWN})*, \d{{5}} {TOWN}",
    rf"\b(?:Calle|C/|Avenida|Avda\.?|Paseo|Plaza|Carrera) (?:(?:de|del|la|las|los) )*{TOWN}(?: {TOWN})*,? \d+(?:, \d+[ºª°](?: ?[A-Z](?![a-z]))?)?, \d{{5}} {TOWN}", rf"\b(?:Rua|Avenida|Av\.|Travessa|Praça|Largo|Estrada) (?:(?:de|do|da|dos|das) )*{TOWN}(?: {TOWN})*, \d+(?:, \d+[ºª°](?: ?\w+)?)?,(?: \d{{4,5}}-\d{{3}})? {TOWN}",
)]
#: Overlapping matches: each looks ahead from a word's start.
PERSONS = [re.compile(rf"(?<![\w@.+'’-])(?=({p})(?![\w@'’-]))") for p in (
    rf"{NAME}(?: [{U}{L}]\.)*(?: wa| WA| Wa| de| DE| van| von| da| el| bin)? {NAME}", rf"(?:wa|WA|Wa) {NAME} {NAME}", rf"(?:wa |WA |Wa )?{NAME}, {NAME}(?: [{U}]\.)*",
    rf"[{U}{L}]\.(?: ?[{U}{L}]\.)*(?: wa| WA| Wa| de| van| von| da)? {NAME}", rf"(?:wa )?{NAME}, [{U}]\.(?: [{U}]\.)*",
)]
NAMES, INITIALS = PERSONS[:3] + PERSONS[4:], PERSONS[3:4]
#: The same in lower case, for which words with a capital aren't looked at.
SMALL = [re.compile(rf"(?<![\w@.+'’-])(?=({p})(?![\w@'’-]))") for p in (
    rf"[{L}]{NAME}(?: [{L}]\.)*(?: wa| de| van| von| da| el| bin)? {NAME}", rf"wa {NAME}(?:,| [{L}]\.)? {NAME}(?: [{U}{L}]\.)*", rf"[{L}]{NAME}, {NAME}(?: [{L}]\.)*", rf"[{L}]\.(?: ?[{L}]\.)* {NAME}",
)]
# Words beside spans of each kind, and beside what only looks like one.
CUES = {
    "person_left": r"(?:in touch with|talk to|spoke to|speak to|speak with|meet with|according to|referred by|signed:|applicant:|candidate|interview with|hello|thanks,|sincerely,\n|wishes,\n|regards\n|sir|frau|herr|madame|monsieur|señora?|senhora?|bwana|bi\.|cc|wrote to|reach|contactez|hable con|fale com|bei|recruiter|reference:|ansprechpartner(?:in)? ist|wasiliana na|pregunte por|ask for|signed as|joindre|questions go to|reporting line:|took over from|badge request:|interviewer|call with dr\.|call with|dear (?:ms|mr|mrs|dr)\.|dr\.|mr\.|ms\.|mrs\.|kontakt:|contact:|ao cuidado de|regards,\n|regards,|—|cheers,\n|name:|c/o|attn:?|\bmanager|\bby) ?$",
    "person_right": r"^ ?(?:,? (?:she|he|they)\b|will (?:meet|interview|call|join|be|show)|leads?\b|joined|manages|runs the|said|asked|wrote|reads|sits|signed|and [a-zà-ÿ’'-]+ [a-zà-ÿ’'-]+ sit| <|, our\b|, born|,? who took over|is also reachable|, phone|, telefon|kwa simu|rated the|\((?:ni |nif|pass|national|id|tax|kitam|ssn|social|pin|perso)|starts on|: strong on|, thank you|, applied twice|, \w+ lead\b|in may\b| : |\(\S+ ?(?:@|\(at\)|\[at\]|at )|, (?:passport|nif|ni number|national id|id no|tax pin|pin|kitambulisho|ssn|social security|personalausweis)|\n|$)",
    "person_not": r"^ ?(?:street|st\.|road|lane|close|avenue|drive|brothers|group|ltd|inc|gmbh|station|team|engineer|carlo|\| )|^-\d",
    "place_left": r"(?:\bin|\bnear|\bsaint|\bto|\bat|\bof|\bthe|\blaunch of|\bmention|\bproject|\boff|\bfrom the|\bbetween|\btried|\d) ?$",
    "phone_left": r"(?:phone|tel(?:efon|ephone|éfono)?\.?|simu|mobile|call|number is|fax|llame al|kept|appel\w*|whatsapp|/|handy|cell)[ :]*$",
    "phone_right": r"^ ?(?:before noon|, ask for|, pregunte|ext)",
    "id_left": r"(?:passport|reisepass|pasaporte|passeport|pasipoti|national id|id no\.?|id card|id number|identity card|personalausweis|ausweis|kitambulisho|nif|dni|ni number|nino|ssn|social security(?: number)?|insurance(?: number| no\.?)?|tax pin|tax id|steuer\w*|kra pin|\bpin|cpf|nie|nir)(?: (?:no\.?|number|namba|nummer|nr\.?|num[ée]ro))?[ :#]*$",
    "other_left": r"(?:order|requisition|ticket|invoice|lot|build|release|version|section|lib@|r-|from|to|no\.|pages?|batch|room|salar\w+|replaces|run of|grace period)[ :#-]*(?:no\.?)?[ :#-]*$",
}
#: For text in lower case.
CUE = {k: re.compile(v) for k, v in CUES.items()}
FILES = {"png", "jpg", "jpeg", "gif", "svg", "js", "css", "py", "zip", "pdf", "md", "txt", "json"}
POSTCODE = re.compile(r"\d{5}|[A-Z]{1,2}\d[A-Z\d]? \d[A-Z]{2}|-\d{5}")


AT_MARKS = ("@", "＠", "&#64;", "(at)", "[at]", "{at}", "<at>", "(a)")
AT_WORD = re.compile(r" (?:at|arobase) (?=\S+ (?:dot|point) )")
DIGITS = re.compile(r"\d(?:[\d() ./+-]|[A-Z](?![a-z])){3,}")
#: Runs of words with a capital, initials and particles among them, with at most commas between.
INITIAL = rf"[{U}]\.(?![{L}])"
CAPITAL = rf"[{U}][{U}{L}]*(?:['’-][{U}{L}]+)*"
RUN = re.compile(rf"(?<![\w@.+'’-])(?:{INITIAL} ?|{CAPITAL})(?:(?:,? (?:(?:wa|de|van|von|da|el|bin) )?)(?:{INITIAL}|{CAPITAL})|(?<=\.){CAPITAL})+")
RUN_WORD = re.compile(rf"(?<![\w.'’-])(?:{INITIAL}|{CAPITAL})")
#: Words of which one stands in every postal address.
PLACES = set("box plot house hse flat apartment apt unit suite block street st road rd lane ln close drive dr avenue ave court ct way crescent gardens place terrace highway boulevard blvd square hill row walk grove park".split()) | set(
    "rue boulevard place chemin impasse allée quai route calle avenida avda av paseo plaza carrera c rua travessa praça largo estrada".split()
)
FRENCH = {"rue", "avenue", "boulevard", "chemin", "impasse", "allée", "quai", "route"}
GERMAN_STREET = ("straße", "strasse", "weg", "gasse", "platz", "allee", "ring", "damm", "ufer", "str.")


def _spans(marks: list, before: int, after: int, length: int) -> list[tuple[int, int]]:
    """The surroundings of marks, which are places or (start, end), merged where they meet."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(m if isinstance(m, tuple) else (m, m) for m in marks):
        lo, hi = max(0, a - before), min(length, b + after)
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def candidates(text: str, low: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all spans that could be personal information; spans may overlap.

    The costly patterns only run around marks that every span of their kind has: an at sign, four
    characters of a number, a word for a street or the like, and for persons two words with a capital
    or a cue or given name.
    """
    out = set()
    at_signs, people, places, cued = marks(text, low)
    for lo, hi in _spans(at_signs, 90, 120, len(text)):
        out |= {("email", m.start(), m.end()) for m in EMAIL.finditer(text, lo, hi)}
    runs = [m.span() for m in DIGITS.finditer(text) if sum(map(str.isdigit, m.group())) >= 6]
    for lo, hi in _spans(runs, 12, 45, len(text)):
        for p in PHONE_FORMS:
            for m in p.finditer(text, lo, hi):
                a = m.start()
                if not (a and (text[a - 1].isalnum() or text[a - 1] in "+-./@(" or re.search(r"\d[ .-]$", text[max(0, a - 2) : a]))) and 7 <= sum(c.isdigit() for c in m.group()) <= 20:
                    out.add(("phone", a, m.end()))
        out |= {("id_number", m.start(), m.end()) for p in IDS for m in p.finditer(text, lo, hi)}
    if places:
        for lo, hi in _spans(places, 90, 110, len(text)):
            out |= {("address", m.start(), m.end()) for p in ADDRESSES for m in p.finditer(text, lo, hi)}
    named = []
    for lo, hi in _spans(people + [a for _, a, _ in out], REACH, REACH, len(text)):
        lo = text.rfind(" ", 0, lo) + 1
        for p in SMALL:
            for m in p.finditer(text, lo, hi + 40):
                if m.start() >= hi:
                    break
                named.append((*m.span(1), False))
    named += [(*m.span(1), False) for at in cued for p in PERSONS if (m := p.match(text, at))]
    common, starts = common_words(), {a for _, a, _ in out}
    for run in RUN.finditer(text):
        heads = [(w.start(), w.group().lower()) for w in RUN_WORD.finditer(text, run.start(), run.end())]
        if all(w in STOP or w in common or w in TECH for _, w in heads):
            continue
        for (at, first), (_, second) in pairwise([*heads, (0, "")]):
            # what would start with a word that no name has, or with two everyday ones, isn't tried
            if len(first) > 2 and (first in STOP or first in TECH) or second in STOP_WORDS or first in common and second in common and first not in GIVEN and second not in GIVEN:
                continue
            named += [(*m.span(1), True) for p in (INITIALS if first[1:] == "." else NAMES) if (m := p.match(text, at)) and m.end(1) <= run.end()]
    known_cues: dict[int, bool] = {}

    def cued_at(at: int) -> bool:
        if at not in known_cues:
            known_cues[at] = bool(CUE["person_left"].search(low[max(0, at - 30) : at]))
        return known_cues[at]

    for a, b, shaped in dict.fromkeys(named):
        words = text[a:b].split()
        bare = [w.strip(".,").lower() for w in words]
        if not STOP_WORDS.isdisjoint(bare) or len(set(bare)) < len(bare):
            continue
        if any(c in text[a:b] for c in "'’-") and not STOP_WORDS.isdisjoint(q for w in bare for q in re.split("['’-]", w)) or any(len(w) == 1 and not x.endswith((".", ".,")) for w, x in zip(bare, words, strict=True)):
            continue
        parts = [q for w in bare for q in w.split("-")]
        known = any(q in GIVEN or len(q) > 3 and q.endswith(ENDINGS) for q in parts)
        # by its shape alone a span is a name unless all its words are everyday ones; in lower case a name or a cue has to speak for it
        if known and text[a:b].islower() and not any(q in GIVEN for q in parts):
            known = bool(CUE["person_right"].search(low[b : b + 40])) or any(b < x <= b + 3 for x in starts)
        if any(w.isupper() and len(w.strip(".,")) > 1 for w in words) and any(q in common and q not in GIVEN for q in parts) and not cued_at(a):
            continue  # a line in capitals, not a name
        if all(w in TECH or w in common for w in bare) and any(w in TECH for w in bare):
            continue
        if known or shaped and not all(w in common or len(w) == 1 for w in bare) or cued_at(a):
            out.add(("person", a, b))
    return sorted(out, key=lambda c: (c[1], c[2], c[0]))


#: Words, and pairs of words, beside which a person may be named.
BESIDE = set("recruiter reference interviewer joindre kontakt contact regards cheers dr ms mr mrs attn phone telefon simu reachable rated".split())
BESIDE_PAIRS = "ask for|signed as|pregunte por|wasiliana na|go to|over from|cuidado de|call with|ansprechpartner ist|ansprechpartnerin ist|reporting line|badge request|starts on|strong on|thank you|took over|applied twice".split("|")
#: Cues that stand in many texts; a name is only looked for where it would start, just behind them.
BESIDE_ENDS = ("name:", "c/o", "manager", "by")
REACH = 60


def lowered(text: str) -> str:
    """Lower case, character by character, so that places stay the same."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


@lru_cache(2)
def common_words(path: str = VOCABULARY) -> frozenset[str]:
    """The words that a public vocabulary holds whole in lower case: everyday words rather than names."""
    with open(path, "rb") as f:
        tokens = (base64.b64decode(line.split()[0]) for line in f)
        return frozenset(t[1:].decode() for t in tokens if len(t) > 3 and t[:1] == b" " and t[1:].isalpha() and t.isascii() and t[1:].islower())


#: What may stand directly before a word.
BORDERS = " \n\r\t\u00a0([{<>/\\-–—_*|\"“”„‘’'`.,:;!?=+&#@0123456789"


@lru_cache(1)
def _finder():
    """An automaton for all marks of at least three characters; each is known as at sign, person or place."""
    import ahocorasick

    a = ahocorasick.Automaton()
    for kind, words in (("at", AT_MARKS), ("end", GERMAN_STREET), ("place", PLACES), ("short", ("st", "rd", "ln", "ct", "av", "c/")), ("title", ("mr", "ms")), ("both", ("dr",)), ("person", BESIDE), ("name", GIVEN), ("pair", BESIDE_PAIRS), ("pair", ("—",)), ("cue", BESIDE_ENDS), ("dot", (" dot ", " point "))):
        for w in words:
            if kind in ("at", "end", "pair", "cue", "dot"):
                a.add_word(w, (kind, len(w), w))
            elif len(w) > 2 or kind in ("short", "title", "both"):  # only behind what may stand before a word: most texts hold many short names inside other words
                for c in BORDERS:
                    a.add_word(c + w, (kind, len(w), w))
    a.make_automaton()
    return a


HOUSE = re.compile(r"\d(?: ?(?:bis|ter))?,? $")


def marks(text: str, low: str) -> tuple[list[int], list[int], list[int], list[int]]:
    """Where at signs, names or cues for them, and words of addresses stand (these with a capital, but for French ones), and where a name would start after one of BESIDE_ENDS."""
    at_signs, people, places, cued, dotted = [], [], [], [], False
    for end, (kind, n, w) in _finder().iter("\n" + low):
        end -= 1
        a = end - n + 1
        if kind == "at":
            at_signs.append(a)
        elif kind == "pair":
            people.append(a)
        elif kind == "end":
            if low[end + 1 : end + 2] == " " and low[end + 2 : end + 3].isdigit():
                places.append(a)
        elif kind == "cue":
            if not (a and low[a - 1].isalpha()):
                cued.append(end + 1 + (low[end + 1 : end + 2] == " "))
        elif kind == "dot":
            dotted = True
        elif kind == "both":
            if not low[end + 1 : end + 2].isalpha():
                people.append(a)
                places.append(a)
        elif not low[end + 1 : end + 2].isalpha():
            if kind == "title":
                people.append(a)
            elif kind == "person" or kind == "name":
                if kind == "person" or text[a].islower():  # names with a capital are found by their shape
                    people.append(a)
            elif text[a].isupper() or w in FRENCH or w == "place" and HOUSE.search(text, max(0, a - 9), a):
                places.append(a)
    if dotted:
        at_signs += [m.start() for m in AT_WORD.finditer(low)]
    return at_signs, people, places, cued


# What stands behind or ends the name of a firm, place or post.
FIRMS = set("ltd inc llc gmbh ag sa plc corp group networks analytics capital consulting energy foods health insurance labs logistics media motors partners payments robotics security services software solutions studio systems technologies ventures bank bridge hall line market award report hospital university college school hotel airport valley lake river island engineer developer manager officer analyst designer director".split())
FIRM = re.compile(r"^,? (?:Ltd|Inc|LLC|GmbH|AG|S\.?A\.?|plc|Corp|Group|& |Bridge|Hall|Line|Market|Award|Report|University|College|School|Hotel|Airport|Engineer|Developer|Manager|Analyst)\b")


def _person_words(span: str) -> list[str]:
    return [w.strip(",.") for w in span.split() if w.strip(",.").lower() not in ("wa", "de", "van", "von", "da", "el", "bin")]


def features(text: str, low: str, kind: str, start: int, end: int, beside: set[int]) -> list[float]:
    """Format and context of a span as numbers; `low` is the text in lower case, `beside` holds where surer spans of other kinds begin."""
    span, left, right = text[start:end], text[max(0, start - 40) : start], text[end : end + 40]
    before, after = low[max(0, start - 30) : start], low[end : end + 40]
    digits = sum(c.isdigit() for c in span)
    near = float(any(p in beside for p in range(end, end + 5)))
    cue = lambda name, side: float(bool(CUE[name].search(before if side is left else after)))
    line = float(left[-1:] in ("\n", "") and right[:1] in ("\n", ""))
    if kind == "person":
        words, common = _person_words(span), common_words()
        parts = [p for w in words for p in w.lower().replace("’", "'").split("-")]
        given = [p in GIVEN for p in parts]
        family = [any(len(q) > 3 and q.endswith(ENDINGS) for q in w.lower().split("-")) for w in words]
        caps = [w[:1].isupper() for w in words]
        start_s = float(not left.strip() or left.rstrip()[-1:] in ".!?\n:—" or left[-1:] == "\n")
        return [
            float(any(given)), float(given[0]), float(given[-1]), float(any(family)), float(family[-1]), float(family[0]), float(all(caps)), float(not any(caps)), float(all(w.isupper() for w in words)),
            float(words[0].isupper() and len(words[0]) > 1 and not words[-1].isupper()), float("," in span), float(bool(re.match(rf"[{U}{L}]\.", span))), float(len(words)), float(min(map(len, words))),
            cue("person_left", left), cue("person_right", right), cue("person_not", right), cue("place_left", left), near, start_s, line, float(bool(re.match(r"[\w'’-]*\w", right))), float(right[:1] in ".,:;)\n" or not right),
            float(left[-2:] in (", ", "; ")), float(bool(re.search(r"[A-Z]\. ?$|\bDr\. ?$", left))), float(sum(p in common for p in parts)), float(any(w.lower() in TECH for w in words)), float(text[max(0, start - 2) : start] == ". " or start == 0), float(parts[0] in common), float(parts[-1] in common),
            float(bool(re.match(r" [a-zà-ÿ]+s\b", right))), float(bool(re.match(r" (?:[a-z]+ed|took|told|put|went|came|sent|gave|has|is|was|does|and|as|on|an?) ", right))), float(bool(re.search(r"(?:\b(?:by|with|from|to|for|and|names?|owe|thank|hi|as|both|was|chair|judge|is),? )$", before))), float(bool(re.match(r",? [A-ZÀ-Þ]", right))), float(bool(FIRM.search(right) or words[-1].lower() in FIRMS)),
        ]
    shape = {"email": [float(bool(re.search(r"@", span))), float(bool(re.search(r"\s", span))), float(re.split(r"\W", span.lower())[-1] in FILES), float(bool(re.match(r"\d", re.split(AT, span, flags=re.I)[-1]))), float(bool(re.search(r"\(at\)|\[at\]|\{at\}", span, re.I))), float(bool(re.search(r"\sat\s", span, re.I))), float(bool(re.search(r"dot", span, re.I)))],
             "phone": [float(span[0] == "+"), float(span.startswith("00")), float(span[0] == "0"), float(span[0] == "("), float(bool(re.fullmatch(r"(?:1[ .-])?\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}.*", span))), float(span.count("-")), float(span.count(" ")), float(span.count("."))],
             "id_number": [float(span[0].isalpha()), float(span[-1].isalpha()), float(span.count("-")), float(span.count(" ")), float(len(span))],
             "address": [float(bool(POSTCODE.search(span))), float(span.count(",")), float(len(span.split())), float(span[:1].isdigit())]}[kind]
    return [*shape, float(digits), cue("phone_left", left), cue("phone_right", right), cue("id_left", left), cue("other_left", left), near, line, float(bool(re.match(r"[-.]?\d", right.lstrip()))), float(bool(re.search(r"[\d,.]\s?$", left)))]


def _syllables(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("b c d f g h j k l m n p r s t v w z br cr dr gr kl pr sk st str th tr".split()) + rng.choice("a e i o u ai ea ou".split()) for _ in range(n))


def _name(rng: random.Random) -> str:
    given = rng.choice(sorted(GIVEN)) if rng.random() < 0.6 else _syllables(rng, rng.choice((1, 2, 2))) + rng.choice(("n", "d", "r", "k", "t", "l", "a", "o", "i"))
    family = _syllables(rng, rng.choice((1, 2, 2))) + (rng.choice("nrdlx") + rng.choice(ENDINGS[:13]) if rng.random() < 0.55 else rng.choice(("n", "k", "ra", "mi", "to", "la", "t")))
    given, family = given.title(), family.title()
    if rng.random() < 0.08:
        given += "-" + rng.choice(sorted(GIVEN)).title()
    if rng.random() < 0.08:
        family += "-" + _syllables(rng, 2).title() + "r"
    if rng.random() < 0.06:
        family = rng.choice(("O'", "wa ")) + family
    middle = f" {rng.choice('ABCDEFGHKLMNPRSTWZ')}." if rng.random() < 0.1 else ""
    form = rng.random()
    if form < 0.55:
        out = f"{given}{middle} {family}"
    elif form < 0.7:
        out = f"{family}, {given}"
    elif form < 0.82:
        out = f"{family.upper()} {given}"
    elif form < 0.9:
        out = f"{given[0]}. {family}"
    else:
        out = f"{family}, {given[0]}." if rng.random() < 0.1 else f"{given} {family}"
    r = rng.random()
    return out.upper() if r < 0.1 else out.lower() if r < 0.2 and form < 0.55 else out


# Names of tools and techniques that look like names.
TECH = set(
    "python sql java go golang rust kotlin docker excel linux unix scala figma react angular vue kafka git github gitlab swift typescript javascript php ruby perl matlab aws azure gcp cloud terraform ansible kubernetes jenkins hadoop spark "
    "airflow dbt snowflake redis mongodb postgresql postgres mysql oracle sqlite graphql rest api apis django flask spring boot nodejs node html css sass tensorflow pytorch keras pandas numpy tableau bi looker jira confluence sap salesforce android ios "
    "flutter dart unity siem selenium cypress photoshop r c dotnet bash windows macos wordpress drupal laravel symfony rails elixir haskell julia hive presto nginx apache grafana prometheus elasticsearch kibana rabbitmq m-pesa".split()
)
SKILLS = ("Power BI", "Spring Boot", "Google Cloud", "Prompt engineering", "Penetration testing", "Machine learning", "REST APIs", "M-Pesa API", "Payment APIs", "Unit testing", "Data modelling", "AWS", "CSS", "HTML", "PHP", "R", "SIEM", "C#", "TypeScript", "MongoDB", "GraphQL", "PostgreSQL", "TensorFlow", *sorted(w.title() for w in TECH if w.isalpha() and len(w) > 3))


def _fill(slot: str, rng: random.Random) -> str:
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    w = lambda n=2: (_syllables(rng, n) + rng.choice("lrntkx")).title()
    d1 = lambda: rng.choice("123456789")
    letter = lambda: rng.choice("ABCDEFGHJKLMNPRSTXZ")
    if slot == "person":
        return _name(rng)
    if slot == "email":
        user = rng.choice((w().lower() + "." + w().lower(), w().lower() + "_" + w().lower() + d(2), w().lower() + "-" + letter().lower(), w().lower() + "+jobs", rng.choice(sorted(GIVEN))))
        host = rng.choice((f"{w().lower()}.example", f"mail.{w().lower()}.test", "example.org", f"{w().lower()}.co.example", f"hr.{w().lower()}.invalid"))
        form = rng.choice(("{u}@{h}",) * 5 + ("{u} @ {h}", "{u}(at){h2}", "{u} [at] {h}", "{u} at {h3}"))
        out = form.format(u=user, h=host, h2=host.replace(".", "(dot)"), h3=host.replace(".", " dot "))
        return out.upper() if rng.random() < 0.12 else out
    if slot == "phone":
        base = rng.choice((f"+254 9{d(2)} {d(3)} {d(3)}", f"+2549{d(8)}", f"09{d(2)} {d(3)} {d(3)}", f"00254 9{d(2)} {d(6)}", f"+44 20 7946 0{d(3)}", f"(020) 7946-0{d(3)}", f"020 7946 0{d(3)}", f"07700 900{d(3)}", f"+447700900{d(3)}", f"+1 ({d(3)}) 555-01{d(2)}",
                           f"{rng.choice('23456789')}{d(2)}-555-01{d(2)}", f"1.{d(3)}.555.01{d(2)}", f"+1 {d(3)} 555 01{d(2)}", f"+49 30 23125{d(3)}", f"030 23125 {d(3)}", f"+49 (0)30 23125-{d(3)}", f"01 99 00 {d(2)} {d(2)}", f"+33 1 99 00 {d(2)} {d(2)}", f"0491 570 {d(3)}", f"+61 491 570 {d(3)}", f"+254-9{d(2)}-{d(3)}-{d(3)}", f"{rng.choice('23456789')}{d(2)}-{d(4)}"))
        return base + (f" ext. {d(3)}" if rng.random() < 0.08 else "")
    if slot == "id_number":
        return rng.choice((f"QQ {d(2)} {d(2)} {d(2)} C", f"9{d(2)}-{d(2)}-{d(4)}", f"9{d(2)} {d(2)} {d(4)}", f"{letter()}{d(9)}{letter()}", f"{d(8)}-{letter()}", f"L{d(2)}X{d(5)}", f"{letter()}{letter()}{d(7)}", f"{letter()}{d(8)}", f"{d(4)} {d(4)}", d(8)))
    if slot == "address":
        return rng.choice((f"P.O. Box {d(4)}-00{d(3)}, {w()}", f"Plot {d(2)}, {w()} Road, {w()}", f"House No. {d(2)}, {w()} Close, off {w()} Road, {w()}", f"Flat {d(1)}, {d(3)} {w()} Lane, {w()}", f"{rng.choice((d1(), d1() + d(1), d1() + d(2)))} {w()} {rng.choice(('St.', 'Street', 'Rd', 'Road', 'Lane', 'Close'))}, {w()} {letter()}{letter()}{d(1)} {d(1)}{letter()}{letter()}",
                           f"{rng.randrange(1, 9999)} {w()} {rng.choice(('Ave', 'Drive', 'Avenue', 'Blvd'))}{rng.choice((f' Apt {d(2)}B', f' Apt {d(2)}B', ' NW', ''))}, {w()}, {rng.choice(('TX', 'OH', 'CA'))} 00{d(3)}", f"{w()}straße {d(2)}, {d(5)} {w()}", f"{w()}weg {d(2)}b, {d(5)} {w()}", f"{rng.choice((d1(), d1() + d(1), d1() + d(2)))} rue de {w()}, {d(5)} {w()}", f"Calle {w()} {d(2)}, 2º B, {d(5)} {w()}", f"Rua {w()}, {d(2)}, {w()}"))
    return {"n": lambda: str(rng.randrange(2, 999)), "w": w, "given": lambda: rng.choice(sorted(GIVEN)).title(), "d2": lambda: d(2), "d3": lambda: d(3), "d4": lambda: d(4), "skill": lambda: rng.choice(SKILLS),
            "group": lambda: rng.choice("billing risk data mobile search growth claims fleet".split()), "d1": lambda: d(1), "label": lambda: rng.choice(("passport", "passport no", "national ID", "ID No.", "tax PIN", "PIN:", "NIF", "NI number", "SSN", "social security number:", "kitambulisho namba", "Personalausweis"))}[slot]()


# The training table: labelled frames (slots named like kinds are labelled) and frames without personal information.
FRAMES = (
    "Please get in touch with {person} by {email}.|{person} will meet you at the front door.|You can reach {person} on {phone} after lunch.|Your first talk is with {person}, our head of {group}.|{person} and {person} sit on the panel.|Mail {email} if the link is broken.|Text {phone} when you arrive.|"
    "My manager, {person}, signed it off.|Applicant: {person}; mobile {phone}; mail {email}.|She wrote to {person} last week, no reply so far.|According to {person}, the {group} budget is gone.|{person} leads the {group} crew.|{person} joined us from {w} in spring.|Passport {id_number} was checked by {person}.|"
    "{label} {id_number} is on file.|Her {label} reads {id_number}.|Copy of {label} {id_number} attached.|He lives at {address} these days.|Post goes to {address}, please.|Parcel for {person}, {address}.|{person}\n{address}\n{phone}\n|Best wishes,\n{person}\n{email}\n|Yours sincerely,\n{person}\n|Kind regards\n{person}\n{address}\n|"
    "Thanks, {person}\n|Hello {person}, your visit is set for noon.|Mr. {person} asked for a second copy.|Dr. {person} reads the reports of the {group} unit.|Emergency contact {person} {phone}|Spoke to {person} ({phone}) about {group}.|{person} <{email}>|Signed: {person}|cc {person}, {person}|Interview with {person} went well.|"
    "Referred by {person}.|Talk to {person} before you sign.|Candidate {person}, born in {w}, holds {label} {id_number}.|Applicant {person}, {label} {id_number}, {phone}.|{person} : {email}\n|{person}: {phone}\n|{person}, {phone}\n|{person} (tel. {phone}) answers questions about the post.|{person} (ID {id_number}) sits in room {n}.|Home address: {address}.|Deliver to {address} between nine and five.|"
    "From {address} it is a short walk.|Her flat is at {address}; before that she had {address}.|We moved the desk of {person} to the third floor.|Fax {phone}, voice {phone}.|The number {phone} no longer works.|Ring {phone} and leave a note.|Those who may ring can use {phone}.|Dial {phone} for the door.|Office: {phone} / {email}|{email} or {phone}, whichever is easier.|Screening notes, {person}: good {skill}, little {skill}.|"
    "{person} ({group}) marked the {skill} test.|We pay {person} by the hour, {label} {id_number}.|The form names {person} as next of kin.|{person}, {address}, wrote twice.|Herr {person}, {address}\n|{person}, {address}; {phone}\n|The {group} lead is {person}, successor of {person}.|{person} ({email}) keeps the list.|Reach out to {person}, {group} lead.\n|"
    "{person} took the minutes.|{person} told us so at lunch.|{person} has all keys.|{person} is our oldest client.|{person} was late again.|{person} works from {w}.|{person} does the {skill} part.|I owe {person} a coffee.|The contract names {person} and {person} as owners.|Greetings from {person}.|The judge, {person}, closed the case.|As {person} put it, nobody asked.|Written by {person}, read by {person}.|Both {person} and {person} failed the {skill} test.|Given to {person} at noon.|We thank {person}.|No word from {person} yet.|It was {person} who found the bug.|Raised by {person}, closed in {w}.|The visa of {person} runs out soon.|Hi {person}, any news?|"
    "Bitte melden Sie sich bei {person} unter {phone}.|Herr {person} ist per {email} zu sprechen.|Frau {person}, {address}\n|Unterlagen an {address} senden.|Ihre Fragen beantwortet {person} gern.|Mit freundlichen Grüßen\n{person}\n|Ausweis {id_number} liegt vor.|Contactez {person} au {phone}.|Madame {person} vous recevra.|"
    "Écrivez à {email} avant lundi.|Dossier à envoyer au {address}.|Cordialement,\n{person}\n|Passeport {id_number} vérifié.|Hable con {person} en el {phone}.|Envíe su solicitud a {email}.|La señora {person} firma los contratos.|Mi dirección es {address}.|Saludos,\n{person}\n|DNI {id_number} en archivo.|"
    "Fale com {person} pelo {phone}.|Mande o currículo para {email}.|Entregar em {address}, por favor.|Atenciosamente,\n{person}\n|Piga simu {phone} umuulize {person}.|Tuma barua kwa {email}.|Anwani yangu ni {address}.|Pasipoti {id_number} imekaguliwa.|{person} anapatikana kwa {phone}."
).split("|")
PLAIN = (
    "The {w} {w} Bridge closes at ten.|{w} {w} GmbH makes pumps for {w}.|We use {skill} and {skill} every day.|{skill} will be part of the test.|{skill} leads the list again.|Version {n}.{n}.{d2} fixes the {group} report.|Call us any time.|The {group} team meets in {w} on Monday.|Pay is {n} 000 to {n} 000 a year.|"
    "Between {n} 000 and {n} 000 people saw it.|Room {d3} is free until 14:30.|Case {d4}-{d3} was reopened.|Case {d2}-{d2}-{d4} is shut.|Tracking code {d4} {d4} {d2}.|See page {n} of the {w} Report.|Founded in 19{d2} by two siblings from {w}.|The track from {w} to {w} is closed.|{w} Street Market opens early.|{given} left early.|Ask {given} about {skill}.|"
    "{given} knows the door code.|Meet us at {w} Hall, second floor.|Follow @{group}jobs for news.|Import {group}@{n}.{n}.{n} from the registry.|Load icons@{n}x.png first, lib@{n}.{n}.{d3} last.|Swap {w}@{d1}x.png for {w}@3x.jpg.|Pictures such as {group}@2x.png are too big.|Used {w} once and liked it?|Host {w} picks port {d4}.|Order {d4}{d4} was shipped.|Ticket #{d4}{d3} is done.|Build {d4}{d4} passed.|Release {d2}.{n}.{n}.{d3} is live.|Batch {d3}-{d2}-{d4} was scrapped.|"
    "Invoice total: {n}.{d2} for {n} units.|Between 2019 and 2024 demand for {skill} grew.|Senior {skill} Developer wanted in {w}.|{w} Analytics and {w} Networks merge.|Apply through {w} Careers, not by post.|Head of Data, {w}\n|Data Engineer at {w} {w} Ltd\n|Offices in New York, San Francisco and {w}|Black Friday brings {n} orders an hour.|"
    "Lake {w} is close by.|Our {w} office is near {w} Station.|A flat near {w} {w} is cheap.|We grew up in {w} {w}.|The {w} Award went to the {group} group.|Kubernetes, Docker and {skill} are a plus.|{w}: {n} open posts\n|Deadline 12/0{d1}/2025, doors 2025-0{d1}-14 10:30.|A {n} x {n} grid, {d2} nodes.|Coordinates {n}.{d4}, {n}.{d4}.|"
    "Open 09:00 - 17:00, closed on public holidays.|ISBN 978-3-{d2}-{d4}{d2}-1|Die Stelle in {w} ist ab sofort frei.|Wir suchen Verstärkung für {w} {w}.|Le poste est basé à {w}.|La oficina de {w} abre en mayo.|Nosso time em {w} cresce.|Kazi hii iko {w}.|Dear Hiring Manager,|Dear Sir or Madam,|Best Regards|Kind Regards|Human Resources, {w} {w} Group|"
    "Equal Opportunity Employer|Full Stack Engineer|Machine Learning Engineer wanted|Product Owner, all genders|Visit {w}.example for more.|Take the {w} Line to {w} Park.|She said {skill} is easy.|Saint {w} lies on the coast.|{w} Brothers and {w} Group share a hall.|{w} & {w} Ltd owns a mill.|The {group} call centre opens at 08:00.|"
    "{skill} Engineer | {w} | Full time\n|{w} | Remote | {skill}\n|Join {w} as {skill} Developer.|From {w} we ship to {w} and {w}.|{w} ({skill}, {skill}) looks for help.|Prices at {w} {w} fell by {n} percent.|Ask for the {skill} sheet.|Ask for {w} prices at the counter.|Node {w} talks to peer {w} over {skill}.|A Monte Carlo test of {n} rounds.|"
    "People ask for {skill} first.|Many ask for {skill} these days.|Shops that want staff ask for {skill} nowadays.|Our stack: {skill}, {skill}, {skill}.|You bring {skill}, {skill} or some {skill}. Looking forward.|Everything here runs on {skill}, {skill} and {skill}.|{w} | {skill}, {skill}\n|The {w} train to {w} runs hourly.|THE {w} FAIR TO {w} RUNS {n} TIMES.|Some budget for billing tooling is left.|{w} ({skill}, {skill}) has an opening.|Some {skill} at any level, {skill} too.|A quiet corner where shelves meet {skill}.|Little fear of {skill}. {skill} helps.|Firms want Power BI, Spring Boot or Google Cloud.|Teams near {w} ask for {skill} as well as {skill}.|By {w} standards the pay is fair.|The manager {skill} plugin is old.|Mention of {w} was rare.|Contact with {w} was lost.|Project {w} ends in May.|After the launch of {w} we hired.|{w}, {w} and {w} have no office.|"
    "Adverts that want {skill} went from {n} to {n}.|Firms that hire cooks ask for {skill} less than for {skill}.|Those who meet targets ask for {skill}.|They like R. Show them {skill} too.|Where the tables meet R. Change nothing.|Score {skill}, {skill} and speech alike.|Between {w} and {w} the rent differs by {n} percent.|If {w} is a past employer, say so.|"
    "Deine Aufgaben|Unser Angebot|Gutes Deutsch in Wort und Schrift.|Sehr gute Kenntnisse in {skill} sind Pflicht.|Schlechte Witze mögen wir nicht.|Alte Zöpfe schneiden wir ab.|Lange Wege gibt es kaum.|Neue Ideen mögen wir sehr.|Meine Adresse steht unten.|Kurze Mails reichen uns.|Träge Abläufe ändern wir; wir fragen viel.|Große Pläne brauchen Zeit.|Leere Worte zählen nicht.|Die Pareto Regel hilft.|The {given} Principle sounds fine.|The {given} {w} Prize is small.|Gute Laune bringst du mit.|Flache Hierarchien und kurze Wege.|Abgeschlossenes Studium oder eine Ausbildung.|Mehrere Jahre Erfahrung mit {skill} wären schön.|Dein Team in {w} freut sich.|Faire Bezahlung, moderne Büros, freie Tage.|"
    "Uma boa equipa, horário livre e seguro de saúde.|Procuramos alguém com experiência em {skill} e vontade de aprender.|O trabalho é remoto, com viagens a {w}.|Damos formação, almoço e um prémio no fim do ano.|Vais desenhar serviços e apoiar os clientes em {w}.|Condições justas e um caminho claro.|Regras de trabalho simples.|Há formas de trabalho para todos, caminho de casa incluído.|Um espelho de trabalho, um ninho de ideias.|"
    "Tunatafuta fundi mwenye bidii na nia njema.|Kazi itaanza mwezi ujao mjini {w}.|Mafunzo hutolewa kazini kila wiki.|Utasaidia wateja {n} na kuandika ripoti.|Tutakujibu ndani ya siku {n}.|Uzoefu wa {skill} ni faida.|Unaweza kufanya kazi ukiwa nyumbani au ofisini.|"
    "Buscamos una persona con ganas de aprender {skill}.|Ofrecemos horario flexible y un buen sueldo en {w}.|El equipo cuida de {n} clientes cada mañana.|Trabajo a distancia con visitas a {w}.|Il nous faut une personne curieuse pour {w}.|Vous aimez {skill} et le travail bien fait.|Horaires souples, bonne humeur et cantine.|Le travail commence lundi, sans essai.|"
    "Account {d4} {d4} {d4} at {w}.|Number of rows: {d4}{d3}.|Section {n}.{n} on page {n}.|Salary {n}.{d3} to {n}.{d3} before tax.|{d3} {d3} {d3} rows in the table."
).split("|")


def training_texts(limit: int = TRAINING_SENTENCES, seed: int = 7) -> list[tuple[str, set[tuple[str, int, int]]]]:
    """Short texts of a few sentences with their labelled spans, at most `limit` sentences."""
    rng, out, made = random.Random(seed), [], 0
    while made < limit:
        text, spans = "", set()
        for _ in range(rng.choice((2, 3, 4))):
            text += rng.choice((" ", " ", " ", "\n")) if text else ""
            frame = rng.choice(FRAMES if rng.random() < 0.6 else PLAIN)
            made += 1
            for k, part in enumerate(re.split(r"\{(\w+)\}", frame)):
                if k % 2:
                    value = _fill(part, rng)
                    if part in KINDS:
                        spans.add((part, len(text), len(text) + len(value)))
                    text += value
                else:
                    text += part
        out.append((text, spans))
    return out


def _rows(text: str) -> tuple[list[tuple[str, int, int]], list[list[float]]]:
    low = lowered(text)
    cands = candidates(text, low)
    beside = {a for k, a, _ in cands if k in ("email", "address")} | {a for k, a, b in cands if k == "phone" and b - a > 8}
    return cands, [features(text, low, k, a, b, beside - {a}) for k, a, b in cands]


@lru_cache(1)
def models() -> dict[str, tuple[Boost, float]]:
    """For each kind the boosted trees and the threshold that is best on held-out texts."""
    xs, ys, held = {k: [] for k in KINDS}, {k: [] for k in KINDS}, {k: [] for k in KINDS}
    for i, (text, spans) in enumerate(training_texts()):
        for c, f in zip(*_rows(text), strict=True):
            xs[c[0]].append(f)
            ys[c[0]].append(float(c in spans))
            held[c[0]].append(i % 4 == 0)
    out = {}
    for k in KINDS:
        x, y, h = np.array(xs[k]), np.array(ys[k]), np.array(held[k])
        b = Boost(rounds=90, depth=4).fit(x[~h], y[~h])
        out[k] = (b, best_threshold(b.probability(x[h]), y[h]))
    return out


#: Kinds whose spans win over others where they overlap with about the same probability.
RANK = {"email": 4, "address": 3, "id_number": 2, "phone": 1, "person": 0}


def select(spans: list[tuple[str, int, int, float]]) -> list[tuple[str, int, int]]:
    """Of overlapping spans the surest, of about equally sure ones the longest."""
    taken: list[tuple[str, int, int]] = []
    for k, a, b, p in sorted(spans, key=lambda s: (-round(s[3], 1), -(s[2] - s[1]), -RANK[s[0]], s[1])):
        if all(b <= x or a >= y for _, x, y in taken):
            taken.append((k, a, b))
    return sorted(taken, key=lambda s: s[1])


def find_in(texts: list[str], fitted: dict[str, tuple[Boost, float]]) -> list[list[tuple[str, int, int]]]:
    rows = [_rows(t) for t in texts]
    chosen: list[list[tuple[str, int, int, float]]] = [[] for _ in texts]
    for k in KINDS:
        where = [(i, c) for i, (cs, _) in enumerate(rows) for c in cs if c[0] == k]
        x = np.array([f for cs, fs in rows for c, f in zip(cs, fs, strict=True) if c[0] == k])
        if where:
            boost, threshold = fitted[k]
            for (i, c), p in zip(where, boost.probability(x), strict=True):
                if p >= threshold:
                    chosen[i].append((*c, float(p)))
    return [select(c) for c in chosen]


def find_personal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, kind, span_start, span_end): each span of personal information, in code points.

    Null ids and texts give no row, nor do texts without any; whole texts are read, however long.
    Repeated documents are answered once an id and span. Other columns don't matter. The trained
    trees, some kilobytes, travel with the tasks.
    """
    fitted = models()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = find_in(pdf[text_col].tolist(), fitted)
            flat = [(i, k, a, b) for i, spans in zip(pdf[id_col], found, strict=True) for k, a, b in spans]
            yield pd.DataFrame(flat, columns=[id_col, "kind", "span_start", "span_end"])

    rows = spread(docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("bigint").alias(id_col), text_col))
    return rows.mapInPandas(run, f"{id_col} bigint, kind string, span_start int, span_end int").distinct()


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by a typed placeholder such as [EMAIL]."""
    for kind, a, b in sorted(spans, key=lambda s: -s[1]):
        text = text[:a] + f"[{kind.upper()}]" + text[b:]
    return text
