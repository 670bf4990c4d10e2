"""Personal information in free text: found, scored and replaced by typed placeholders.

Regular expressions propose spans with a score below ``THRESHOLD``. Validators (Luhn for social
insurance numbers, mod-11 for health numbers, mod-97 for account numbers, the numbering plan for
telephones, the letters in use for postal codes) and the words before and after lift or lower it;
a span counts from ``THRESHOLD`` on. So a labelled social insurance number whose check digit is
wrong is none, nor is a number with a right check digit that the words before call a sample.

Every expression is tried only where it can begin: the starts come from one pass over the digits
and one pass of an Aho-Corasick automaton over the cue words, which changes no result.

Runs on whole texts in Arrow batches; a text is one row, so nothing is shuffled but the input,
which is spread because few files would otherwise mean few tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.session import spread

THRESHOLD = 0.5
KINDS = ("email", "phone", "id_number", "address", "name")

# ---------------------------------------------------------------- validators


def luhn(digits: str) -> bool:
    """Check digit of social insurance and payment card numbers."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return bool(digits) and total % 10 == 0


def mod11_health(digits: str) -> bool:
    """Check digit of ten-digit health numbers that begin with 9."""
    if len(digits) != 10 or digits[0] != "9":
        return False
    # The weights of digits 2 to 9.
    rest = sum(int(d) * w % 11 for d, w in zip(digits[1:9], (2, 4, 8, 5, 10, 9, 7, 3)))
    return (11 - rest % 11) % 11 == int(digits[9])


def mod97(account: str) -> bool:
    """Check digits of an international bank account number."""
    s = re.sub(r"\s", "", account).upper()
    moved = s[4:] + s[:4]
    return len(s) > 14 and moved.isalnum() and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def dialable(digits: str) -> bool:
    """Ten digits of the North American plan: area code and exchange begin with 2 to 9."""
    return len(digits) == 10 and digits[0] > "1" and digits[3] > "1"


# ---------------------------------------------------------------- proposals

UP = "A-ZÀ-ÖØ-ÞŒŠŽ"
LOW = "a-zß-öø-ÿœšž"
DASH = r"\-‐‑‒–"

EMAIL = re.compile(
    rf"(?<![\w.+%-])[\w](?:[\w.+%{DASH}]*[\w])?"
    r"(?:\s?@\s?|\s*[(\[{<]\s*(?:at|arobase|à|@)\s*[)\]}>]\s*|\s+(?:at|arobase)\s+(?=[\w-]+(?:\s+(?-i:dot|point|DOT|POINT)\s+[\w-]+)))"
    r"[a-z0-9](?:[\w-]*\w)?(?:(?:\.|\s*[(\[{<]\s*(?:dot|point|\.)\s*[)\]}>]\s*|\s+(?-i:dot|point|DOT|POINT)\s+)[a-z0-9](?:[\w-]*\w)?)+",
    re.I,
)
BRACKET_AT = re.compile(r"[(\[{<]\s*(?:at|arobase|à)\s*[)\]}>]", re.I)
SPACED_DOT = re.compile(r"\s(?:dot|point|DOT|POINT)\s")
SPACED_AT = re.compile(r"\s(?:at|arobase)\s+[\w-]+\s+(?-i:dot|point|DOT|POINT)\s", re.I)
LOCAL = re.compile(rf"[\w.+%{DASH}]")
_D = "[0-9OolI]"
PHONE = re.compile(
    rf"(?<![\w+.{DASH}])(?<!\d/)(?:(?:\+\s?)?1[\s.{DASH}]?)?(?:\([2-9]{_D}{{2}}\)\s?|[2-9]{_D}{{2}}[\s./{DASH}]?\s?){_D}{{3}}[\s.{DASH}]?\s?{_D}{{4}}(?![\w/+]|[{DASH}.]\d)"
)
PHONE_LABEL = re.compile(r"(?i)\b(?:t[eé]l|phone|fax|cell|mobile|text|call|son|t[eé]l[eé]c(?:opieur)?|daytime|home|reach me|joindre|sms|ph)\b[\w\s.:()#’']{0,24}$")
# Numbers of things: what stands right before decides.
THING = re.compile(
    r"(?i)\b(?:sample|work order|purchase order|order|invoice|permit|meter|batch|lot|certificate|hearing|parcel|file|licence plate|serial|ref(?:erence)?|item|coordinates|"
    r"[eé]chantillon|bon(?: de travail)?|facture|commande|permis|compteur|certificat|audience|parcelle|dossier|s[eé]rie|num[eé]ro de lot)"
    r"(?:\s+(?:no\.?|number|num[eé]ro|#|n[o°]\.?))?\s*[:#]?\s*$"
)

ID_LABEL = re.compile(
    r"(?i)(?:\bs\.?\s?i\.?\s?n\b\.?|social insurance|assurance[\s-]sociale|\bn\.?\s?a\.?\s?s\b\.?|passe?port\w*|licen[cs]e|permis de conduire|\bdl\b|"
    r"health (?:card|number|care)|\bphn\b|\bohip\b|\bramq\b|assurance[\s-]maladie|carte (?:sant[eé]|soleil)|medicare|care card|iban)"
)
# The label right before a value, with what may stand between them.
ID_BEFORE = re.compile(rf"(?:{ID_LABEL.pattern})(?i:\s*(?:number|num[eé]ro|no|n[o°]|card|#|is|est|was|:|\.|\(|-))*\s*$".replace("(?i)", ""), re.I)
ID_VALUE = re.compile(
    rf"(?<![\w{DASH}])(?:[A-Z]{{2}}\d{{2}}(?:\s?[A-Z0-9]{{4}}){{3,7}}(?:\s?[A-Z0-9]{{1,3}})?|[A-Z]{{4}}[\s{DASH}]?\d{{4}}[\s{DASH}]?\d{{4}}|[A-Z]\d{{4}}[\s{DASH}]?\d{{5,6}}[\s{DASH}]?\d{{2,5}}|[A-Z]{{1,2}}\s?\d{{6,7}}|"
    rf"\d{{6}}[\s{DASH}]\d{{3}}|\d{{4}}[\s{DASH}]?\d{{3}}[\s{DASH}]?\d{{3}}(?:[\s{DASH}]?[A-Z]{{2}})?|[0-9Ol]{{3}}[\s.{DASH}]?[0-9Ol]{{3}}[\s.{DASH}]?[0-9Ol]{{3}})(?![\w]|[{DASH}.]\d)"
)
SIN_SHAPE = re.compile(rf"(?<![\w.{DASH}+#])\d{{3}}([\s.{DASH}]?)\d{{3}}\1\d{{3}}(?![\w]|[{DASH}.]\d)")

# Street types, unit words and provinces as written on mail.
STREET = (
    r"(?:Street|St|Avenue|Ave|Av|Road|Rd|Drive|Dr|Lane|Ln|Boulevard|Blvd|Boul|Crescent|Cres|Court|Crt|Ct|Place|Pl|Way|Terrace|Terr|Trail|Tr|Close|Circle|Cir|"
    r"Square|Sq|Gate|Grove|Highway|Hwy|Parkway|Pkwy|Heights|Hts|Bay|Row|Rang|Range Road|Rge Rd|Township Road|Twp Rd|Concession|Line|Sideroad|Side Road)"
)
FR_STREET = r"(?:rue|avenue|av\.|boulevard|boul\.|chemin|ch\.|route|rang|place|all[eé]e|c[oô]te|mont[eé]e|impasse|promenade)"
UNIT = r"(?:(?i:Unit|Suite|Ste|Apt|Apartment|App|Appartement|Bureau|Unité|Room|Floor)|\#)\.?\s*\#?\s?\w{1,6}"
PROVINCE = (
    r"(?:AB|BC|MB|NB|NL|NS|NT|NU|ON|PE|QC|SK|YT|A\.B\.|B\.C\.|N\.B\.|N\.L\.|N\.S\.|P\.E\.I\.|Alta\.?|Sask\.?|Man\.?|Ont\.?|Que\.?|Qu[eé]\.?|"
    r"Alberta|British Columbia|Manitoba|New Brunswick|Newfoundland|Nova Scotia|Ontario|Qu[eé]bec|Saskatchewan|Yukon|Colombie-Britannique|Nouveau-Brunswick|Nouvelle-[EÉ]cosse)"
)
POSTAL = r"[A-Z]\d[A-Z]\s?\d[A-Z]\d"
_TOWN = rf"[{UP}][\w'’.]*(?:-[\w'’]+)*(?:[ \u00a0][{UP}][\w'’]*(?:-[\w'’]+)*){{0,3}}"
_TAIL = rf"(?:{_TOWN}(?:,?\s*\(?\b{PROVINCE}(?!\w)\)?)?(?:,?\s*{POSTAL}\b)?|{POSTAL}\b)"
_CIVIC = (
    rf"(?:{UNIT}\s*[,{DASH}]?\s*)?\d{{1,6}}[A-Z]?(?:[{DASH}]\d{{1,6}})?,?[ \u00a0]+"
    rf"(?:{FR_STREET}\s+\d{{1,4}}(?:e|er|re)?\b|{FR_STREET}\s+(?:d[eu]s?\s+|de\s+la\s+|d['’])?[{UP}][\w'’-]*(?:[ -][{UP}][\w'’-]*){{0,3}}|(?:\d{{1,3}}(?:st|nd|rd|th|e)?|[{UP}][\w'’.-]*)(?:\s(?:\d{{1,3}}|[{UP}][\w'’-]*)){{0,3}}?\s{STREET}\b\.?(?:\s\d{{1,4}}(?!\d)(?:\s{STREET}\b\.?)?)?|"
    rf"(?:Range Road|Rge Rd|Township Road|Twp Rd|Highway|Hwy|Concession|Line|Rang)\s\d{{1,4}}(?:\s{STREET}\b\.?)?)"
    rf"(?:\s(?:NW|NE|SW|SE|N|S|E|W|Nord|Sud|Est|Ouest)\b\.?)?(?:,?\s*{UNIT})?"
)
_BOX = rf"(?:(?:P\.?\s?O\.?\s*)?\bBox\s\d{{1,6}}|\b(?:C\.\s?P\.|CP|Case postale)\s\d{{1,6}}|\bR\.?\s?R\.?\s?\#?\s?\d{{1,3}}(?:,?\s(?:Site|Comp)\.?\s\d{{1,4}})?(?:,?\s(?:Box|Comp)\.?\s\d{{1,5}})?|\b(?:General Delivery|Poste restante))(?:,?\s(?:Stn|Station|Succ\.?)\s[{UP}\d]\w*)?"
ADDRESS = re.compile(rf"(?<![\w{DASH}.+/])(?:{_CIVIC}|{_BOX})(?:\s*[,\n]\s*(?:{_BOX}\s*[,\n]\s*)?{_TAIL})")
# A box or civic line whose town comes without a comma still ends with a postal code.
ADDRESS_CODE = re.compile(rf"(?<![\w{DASH}.+/])(?:{_CIVIC}|{_BOX})\s+{_TOWN}[,\s]*\(?(?:{PROVINCE})?\)?[,\s]*{POSTAL}\b")
POSTAL_CODE = re.compile(rf"\b{POSTAL}\b")
ADDRESS_HINT = re.compile(r"\d|Delivery|restante")

PROVINCE_IN = re.compile(rf"(?<!\w){PROVINCE}(?!\w)")
TOWN_IN = re.compile(rf"[,\n]\s*{_TOWN}")
LIVES = re.compile(r"(?i)\b(?:live|lives|living|reside|resides|home|house|address|mail|farm|at|from|habite|demeure|adresse|domicile|au)\b")
OWNER = re.compile(r"(?i)\b(?:my|our|his|her|their|the form shows|mon|ma|notre|son|sa)\b")
SIN_NAMED = re.compile(r"(?i)s\.?\s?i\.?\s?n|social|sociale|n\.?\s?a\.?\s?s")

# ---------------------------------------------------------------- names

_W = rf"(?:[{UP}][\w'’]*[\w](?:-[{UP}][\w'’]*)*)"
_I = rf"[{UP}]\.(?:-[{UP}]\.)?"
_NAME = rf"(?:{_W},[ \u00a0]+(?:{_W}|{_I})(?:[ \u00a0]{_I})?|(?:{_W}|{_I})(?:[ \u00a0]{_I}){{0,2}}[ \u00a0\n]{_W})"
_ONE = rf"(?:{_NAME}|{_W})"
# A capital or small-letter signature line.
_LOOSE_WORD = rf"[{UP}{LOW}][\w'’]*(?:-[\w'’]+)*"
_LINE = rf"(?:{_LOOSE_WORD},[ \u00a0]+{_LOOSE_WORD}(?:[ \u00a0][{UP}{LOW}]\.)?|(?:{_LOOSE_WORD}|[{UP}{LOW}]\.)(?:[ \u00a0][{UP}{LOW}]\.){{0,2}}(?:[ \u00a0]{_LOOSE_WORD}){{1,2}})"

TITLED = re.compile(rf"\b(?:(?:Mr|Mrs|Ms|Miss|Mx|Dr|Mme|Mlle|Prof|Rev|Sr|Me|MR|MRS|MS|DR|MME)\b\.?|Elder|Chief|Councillor|Madame|Monsieur|Docteure?|Ma[iî]tre|ELDER|CHIEF),?\s+({_ONE})")
FR_M = re.compile(rf"(?<![\w{DASH}'’])[{LOW}][\w'’]*\s+M\.\s+({_ONE})")
LIST = re.compile(
    rf"(?:\b(?:Present|Attendees|Attendance|In attendance|Submitted by|Contact|Copy to|Copies to|Prepared by|Written by|From|Name|Witness(?:es)?|Author|[Cc]c|CC|Participants?|"
    rf"Pr[eé]sents?|Pr[eé]sences|Copie|Copie à|Personne-ressource|Personnes-ressources|Soumis par|Pr[eé]par[eé] par|T[eé]moins?|Nom)\s*(?:[:\-–—]\s*)|\bCopie à\s*:\s*)(?=\w)"
)
LIST_ITEM = re.compile(rf"({_ONE})\s*(;|,(?= [{UP}])|and|et)?\s*")
BY = re.compile(
    rf"\b(?:[Aa]ccording to|[Ss]elon|[Dd]'apr[eè]s|signed by|sign[eé]e? par|written by|prepared by|[eé]crite? par|spoke (?:to|with)|talked (?:to|with)|speak with|parl[eé] de cette question avec|parl[eé] (?:avec|à)|avec|"
    rf"my (?:late )?(?:uncle|aunt|father|mother|husband|wife|son|daughter|brother|sister|neighbou?r|friend|grandfather|grandmother|cousin)|"
    rf"mon (?:d[eé]funt )?(?:oncle|p[eè]re|mari|fils|fr[eè]re|voisin|ami)|ma (?:d[eé]funte )?(?:tante|m[eè]re|femme|fille|s[oœ]eur|voisine|amie)|my name is|je m['’]appelle)\s+({_NAME})"
)
DOES = re.compile(
    rf"(?<![\w-])({_NAME})(?=(?:['’]s\s+(?:barn|house|farm|land|field|home|property|well|gate|dugout|pasture|yard|cattle|cabin|shop|family|driveway|fence)\b|\s*\((?:landowner|resident|intervenor|propri[eé]taire|r[eé]sidente?|tenant|owner)\)|"
    rf"\s+(?:told|asked for|asked why|walked|said|wrote|testified|stated that (?:he|she|they)|a dit|a demand[eé]|nous a dit|nous a racont[eé]|a [eé]crit)\b))"
)
CLOSING = re.compile(
    rf"(?im)^(?:Sincerely|Yours (?:truly|sincerely|faithfully)|Respectfully(?: submitted)?|Thanks|Thank you|Regards|(?:Best|Kind|Warm) regards|Best|Cordialement|Merci|Salutations|Bien à vous|Sinc[eè]rement|"
    rf"Veuillez agr[eé]er[^\n]*|Respectueusement)[,.]?[ \u00a0]*\n\s*({_LINE})[ \u00a0]*$"
)
HEAD = re.compile(rf"\A\s*({_LINE})[ \u00a0]*\n(?=[^\n]*(?:\d|@|\bat\b|Box|R\.R\.))")
CAPITAL = re.compile(rf"(?<![\w-])[{UP}]")
PLACE_BEFORE = re.compile(r"\b(?:of|at|in|near|from|to|de|du|à|par|près)\s+$")
_SMALL = rf"[{LOW}][\w'’]*(?:-[\w'’]+)*"
_PAIR = rf"(?:{_SMALL},[ ]+{_SMALL}|(?:{_SMALL}|[{LOW}]\.)(?:[ ][{LOW}]\.)?[ ]{_SMALL})"
# Names typed without capitals, where the words around leave no doubt.
SMALL_BY = re.compile(rf"\b(?:signed by|sign[eé]e? par|parl[eé] de cette question avec|my late (?:uncle|aunt))\s+({_PAIR})(?=\s+(?:on behalf|au nom|la semaine|and|et)\b|[.,;])")
SMALL_DOES = re.compile(rf"\b(?:On (?:Mon|Tues|Wednes|Thurs|Fri|Satur|Sun)day|According to|Selon)\s+({_PAIR})(?=,|\s+(?:told|asked|walked|said|wrote)\b)")
SMALL_ITEM = re.compile(rf"({_PAIR})\s*(?=[;.\n]|,\s*t[eé]l|$|and\b|et\b)(;|and|et)?\s*")

NOT_NAME = frozenset(  # fixed values: words that stand where a name could
    "monsieur madame sir dear hello hi commission secretary board panel chair chairperson counsel staff member members the this that these those table condition order hearing project program "
    "programme line energy pipeline pipelines pipe resources corporation inc ltd llc lp ulc corp limited company holdings group groupe drilling survey services transmission midstream midstreams "
    "power gas storage environmental assessment information request response appendix attachment letter volume part route sheet revision version note notes our we they you he she it in on at as for from "
    "to and or if when what where why how because although neither nobody several approximately between measurements monitoring staff crews weather intervenors please no a an i is of by date re subject "
    "received copy fax tel phone email courriel objet le la les un une des du de au aux il elle nous vous ils notre ce cette ces qui que si selon environ pendant personne plusieurs puisque "
    "january february march april june july august september october november december monday tuesday wednesday thursday friday saturday sunday "
    "janvier février mars avril mai juin juillet août septembre octobre novembre décembre lundi mardi mercredi jeudi vendredi samedi dimanche thanks sincerely respectfully regards cordialement".split()
)
COMPANY_AFTER = re.compile(
    rf"(?:[ \u00a0]+(?:&|and|et)[ \u00a0]+(?:Sons?|Fils|Associates|Co|Company|Brothers|Bros|Partners)\b|(?:[ \u00a0]+(?:{_W}|&|\([A-Z]\w+\))){{0,4}}?[ \u00a0]+(?:Inc|inc|Ltd|lt[eé]e|LLC|LP|ULC|Corp|Corporation|Limited|Holdings|Group|Company|Drilling|Survey|Surveys|Services|Energy|Pipelines?|Pipe|Resources|"
    rf"Forage|Consulting|Engineering|Contracting|Trucking|Farms?|Ranch(?:es)?|Creek|Lake|River|Road|Street|Avenue|Ridge|Crossing|Field|Expansion|Program|Project|Line|Loop|Upgrade|Midstream|Transmission|Storage|Power)\b)"
)
COMPANY_BEFORE = re.compile(r"(?:\b(?:Groupe|Group|Soci[eé]t[eé]|Entreprises?|Gazoduc|Firm|Maison|Ferme|Companies)[ \u00a0]+|&[ \u00a0]+|@)$")


# ---------------------------------------------------------------- where expressions can begin

# The literal beginnings of each expression, in small letters.
_WORDS = {
    "titled": "mr mrs ms miss mx dr mme mlle prof rev sr me elder chief councillor madame monsieur docteur maître maitre".split(),
    "fr_m": ["m."],
    "list": ["present", "attend", "in attendance", "submitted by", "contact", "copy to", "copies to", "prepared by", "written by", "from", "name", "witness", "author", "cc", "participant", "présent", "présence", "copie", "personne", "soumis par", "prépar", "prepar", "témoin", "temoin", "nom"],
    "by": ["according to", "selon", "d'après", "signed by", "signé", "signe", "written by", "prepared by", "écrit", "ecrit", "spoke", "talked", "speak with", "parlé", "parle", "avec", "my ", "mon ", "ma ", "je m"],
    "small_by": ["signed by", "signé", "signe", "parlé de", "parle de", "my late"],
    "small_does": ["on ", "according to", "selon"],
    "does": ["'s", "’s", "(landowner)", "(resident)", "(intervenor)", "(propri", "(résident", "(resident", "(tenant)", "(owner)", "told", "asked", "walked", "said", "wrote", "testified", "stated that", "a dit", "a demand", "nous a", "a écrit", "a ecrit"],
    "address": ["unit", "suite", "ste", "apt", "apartment", "app", "bureau", "room", "floor", "#", "p.", "po", "p o", "box", "c.", "cp", "case postale", "r.", "rr", "r r", "general delivery", "poste restante"],
}


def _automaton() -> ahocorasick.Automaton:
    by: dict[str, set[str]] = {}
    for name, words in _WORDS.items():
        for w in words:
            by.setdefault(w, set()).add(name)
    a = ahocorasick.Automaton()
    for w, names in by.items():
        a.add_word(w, (len(w), tuple(sorted(names))))
    a.make_automaton()
    return a


CUES = _automaton()
DIGIT = re.compile(r"\d+")


def _starts(text: str) -> dict[str, list[int]] | None:
    """Places where each kind of expression can begin, in order. None if small letters would shift places."""
    low = text.lower()
    if len(low) != len(text):
        return None
    out: dict[str, list[int]] = {name: [] for name in _WORDS}
    for end, (n, names) in CUES.iter(low):
        at = end - n + 1
        for name in names:
            out[name].append(at)
    return out


def _at(pattern: re.Pattern, text: str, starts: list[int] | None) -> Iterator[re.Match]:
    """What ``finditer`` gives, trying only the given places; all places if there are none given."""
    if starts is None:
        yield from pattern.finditer(text)
        return
    after = 0
    for s in sorted(set(starts)):
        if s >= after and (m := pattern.match(text, s)):
            yield m
            after = m.end()


def _does(text: str, cues: list[int] | None) -> Iterator[re.Match]:
    """Matches of DOES: capital letters close before a cue, as a name stands right before it."""
    if cues is None:
        yield from DOES.finditer(text)
        return
    starts: set[int] = set()
    for c in cues:
        # The words before the cue, line by line at most: a name has no more than a handful.
        low = c
        for _ in range(9):
            low = max(text.rfind(" ", 0, max(low - 1, 0)), text.rfind("\n", 0, max(low - 1, 0)), text.rfind("\u00a0", 0, max(low - 1, 0))) + 1
            if low <= 0:
                break
        starts.update(m.start() for m in CAPITAL.finditer(text, max(0, low), c))
    yield from _at(DOES, text, list(starts))


def _names(text: str, cues: dict[str, list[int]] | None) -> Iterator[tuple[int, int, float]]:
    """(start, end, score): a proposal has 0.3; the words that introduce or follow it decide."""
    def ok(s: int, e: int, loose: bool = False) -> bool:
        words = re.findall(r"[^\W\d_]+", text[s:e])
        if not words or any(c.isdigit() for c in text[s:e]) or any(len(w) > 1 and w.casefold() in NOT_NAME for w in words):
            return False
        return loose or any(len(w) > 1 for w in words)

    def score(s: int, e: int, cue: float) -> float:
        """The cue lifts a proposal; a company, place or project around it takes that back."""
        return 0.3 + cue - 0.8 * bool(COMPANY_AFTER.match(text, e)) - 0.8 * bool(COMPANY_BEFORE.search(text, max(0, s - 14), s))

    def trim(s: int, e: int) -> int:
        """Give back a possessive or words that cannot end a name."""
        while e - s > 2 and text[e - 2 : e] in ("'s", "’s"):
            e -= 2
        return e

    on = (lambda name: None) if cues is None else cues.get
    for m in _at(TITLED, text, on("titled")):
        s, e = m.span(1)
        words = text[s:e].split()
        # A word of the sentence behind the surname is none of the name.
        while len(words) > 1 and re.sub(r"\W", "", words[-1]).casefold() in NOT_NAME:
            words.pop()
            e = s + len(text[s:e].rstrip().rsplit(None, 1)[0].rstrip(" ,"))
        if ok(s, trim(s, e)):
            yield s, trim(s, e), score(s, trim(s, e), 0.6)
    for m in FR_M.finditer(text) if cues is None else filter(None, (FR_M.match(text, at) for c in on("fr_m") if (at := _word_before(text, c)) is not None)):
        if ok(*m.span(1)):
            yield *m.span(1), score(*m.span(1), 0.55)
    for m in _at(LIST, text, on("list")):
        at = m.end()
        while True:
            i = LIST_ITEM.match(text, at) or SMALL_ITEM.match(text, at)
            if not i or not ok(*i.span(1)) or score(*i.span(1), 0.5) < THRESHOLD:
                break
            yield *i.span(1), score(*i.span(1), 0.5)
            at = i.end()
            if not i.group(2):
                break
    for m in _at(BY, text, on("by")):
        if ok(*m.span(1)):
            yield m.start(1), trim(*m.span(1)), score(*m.span(1), 0.5)
    for m in _does(text, on("does")):
        s, e = m.start(1), trim(*m.span(1))
        first = re.match(r"(\w+)\s+(?=\w+\W+\w)", text[s:e])
        if first and first[1].casefold() in NOT_NAME:  # a weekday before the name
            s += first.end()
        if ok(s, e):
            yield s, e, score(s, e, 0.45 - 0.6 * bool(PLACE_BEFORE.search(text, max(0, s - 12), s)))
    for pattern, name in ((SMALL_BY, "small_by"), (SMALL_DOES, "small_does")):
        for m in _at(pattern, text, on(name)):
            if ok(*m.span(1)):
                yield *m.span(1), score(*m.span(1), 0.4)
    for m in CLOSING.finditer(text):
        if ok(*m.span(1), loose=True):
            yield *m.span(1), score(*m.span(1), 0.6)
    m = HEAD.match(text)
    if m and ok(*m.span(1)):
        yield *m.span(1), score(*m.span(1), 0.4)


def _word_before(text: str, at: int) -> int | None:
    """Start of the word that stands before white space before ``at``."""
    e = at
    while e and text[e - 1].isspace():
        e -= 1
    s = e
    while s and (text[s - 1].isalnum() or text[s - 1] in "_'’"):
        s -= 1
    return s if s < e < at else None


# ---------------------------------------------------------------- scoring

_ZERO = str.maketrans("OolI", "0011")


# Capital letters and misread digits an identity number can begin with.
_ID_STARTS = "ABCDEFGHIJKLMNOPQRSTUVWXYZl"


def _shifted(text: str, digits_at: list[int], first: str) -> list[int]:
    """The digits' places and those up to six characters before that begin with one of ``first``, as a sign or letters may stand before the digits."""
    out = set(digits_at)
    for d in digits_at:
        for s in range(max(0, d - 6), d):
            if text[s] in first:
                out.add(s)
    return sorted(out)


def _emails(text: str) -> Iterator[re.Match]:
    """Matches of EMAIL, tried from the word before each at-sign or what stands for one."""
    marks, at = [], text.find("@")
    while at >= 0:
        marks.append(at)
        at = text.find("@", at + 1)
    marks += [m.start() for m in BRACKET_AT.finditer(text)]
    if SPACED_DOT.search(text):
        marks += [m.start() for m in SPACED_AT.finditer(text)]
    starts = []
    for e in marks:
        while e > 0 and (text[e - 1].isspace() or text[e - 1] in "([{<"):
            e -= 1
        s = e
        while s > 0 and LOCAL.match(text, s - 1):
            s -= 1
        while s < e and not text[s].isalnum() and text[s] != "_":
            s += 1
        starts.append(s)
    return _at(EMAIL, text, starts)


def _id_score(text: str, m: re.Match) -> float:
    """0.3 for the shape; the label before and the check digit decide, a number that is called a thing is none."""
    digits = re.sub(r"\D", "", m[0].translate(_ZERO))
    before = text[max(0, m.start() - 60) : m.start()]
    label = ID_BEFORE.search(before)
    if not label:  # the label may stand off, but then the check digit must be right
        return 0.1 + 0.25 * luhn(digits) + 0.4 * bool(ID_LABEL.search(before)) - 0.6 * bool(THING.search(before)) if SIN_SHAPE.fullmatch(m[0]) else 0.0
    named = ID_LABEL.search(label[0])[0].casefold()
    own = 0.05 * bool(OWNER.search(before))
    if "iban" in named or re.match(r"[A-Z]{2}\d{2}\s?[A-Z0-9]{4}", m[0]) and len(m[0]) > 14:
        return 0.4 + own + (0.4 if mod97(m[0]) else -0.1)
    if SIN_NAMED.search(named):
        return 0.4 + own + (0.4 if len(digits) == 9 and luhn(digits) else -0.1)
    # Passports, licences and health cards of most provinces have no public check digit; their shape counts, a right one adds.
    return 0.55 + own + 0.3 * mod11_health(digits)


def _address_score(text: str, m: re.Match) -> float:
    """0.4 for the shape; a valid postal code, a province, a box, and words of dwelling or mail around lift it, a number of a thing lowers it."""
    code = POSTAL_CODE.search(m[0])
    valid = bool(code and not set(code[0]) & set("DFIOQU") and code[0][0] not in "WZ")
    score = 0.4 + (0.3 if valid else -0.1 if code else 0.0) + 0.2 * bool(PROVINCE_IN.search(m[0])) + 0.1 * bool(TOWN_IN.search(m[0])) + 0.1 * bool(LIVES.search(text, max(0, m.start() - 60), m.start()))
    return score - 0.5 * bool(THING.search(text[max(0, m.start() - 40) : m.start()]))


def find(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) of every place, in order, without overlaps. Null and empty give none."""
    if not text:
        return []
    spans: list[tuple[str, int, int, float]] = []
    cues = _starts(text)
    for m in _emails(text):
        # A plain at-sign is proof; a disguise is believed for the domain that is spelled out behind it.
        spans.append(("email", *m.span(), 0.4 + 0.55 * bool("@" in m[0] or re.search(r"\W(?:dot|point)\W|\.", m[0], re.I))))
    digits_at = [m.start() for m in DIGIT.finditer(text)]
    if digits_at:
        for m in _at(PHONE, text, _shifted(text, digits_at, "+(")):
            digits = re.sub(r"\D", "", m[0].translate(_ZERO))[-10:]
            before = text[max(0, m.start() - 40) : m.start()]
            score = 0.3 + (0.3 if dialable(digits) else -0.4) + 0.1 * (m[0][0] in "+(" or not m[0].isdigit())
            score += 0.3 * bool(PHONE_LABEL.search(before)) - 0.6 * bool(THING.search(before)) - 0.5 * bool(ID_LABEL.search(before[-26:]))
            if sum(c in "OolI" for c in m[0]) > 2:
                score -= 0.5
            spans.append(("phone", *m.span(), round(score, 4)))
        for m in _at(ID_VALUE, text, _shifted(text, digits_at, _ID_STARTS)):
            spans.append(("id_number", *m.span(), _id_score(text, m)))
        for m in _at(SIN_SHAPE, text, digits_at):
            spans.append(("id_number", *m.span(), _id_score(text, m)))
    if digits_at or ADDRESS_HINT.search(text):
        starts = None if cues is None else digits_at + cues["address"]
        for pattern in (ADDRESS, ADDRESS_CODE) if POSTAL_CODE.search(text) else (ADDRESS,):
            for m in _at(pattern, text, starts):
                spans.append(("address", *m.span(), _address_score(text, m)))
    spans += [("name", s, e, score) for s, e, score in _names(text, cues)]
    best: list[tuple[str, int, int, float]] = []
    for x in sorted((x for x in spans if x[3] >= THRESHOLD), key=lambda x: (-x[3], x[1] - x[2], x[1])):
        if all(x[2] <= y[1] or x[1] >= y[2] for y in best):
            best.append(x)
    return sorted(best, key=lambda x: x[1])


def redact(text: str | None) -> str | None:
    """The text with a placeholder such as [NAME] in each place; null stays null."""
    if not text:
        return text
    out, at = [], 0
    for kind, s, e, _ in find(text):
        out += [text[at:s], f"[{kind.upper()}]"]
        at = e
    return "".join(out) + text[at:]


# ---------------------------------------------------------------- operators


def places(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, kind, start_pos, end_pos, score): code points counted from 1, the end inclusive.

    Null and empty texts give no row; whole texts are searched whatever their length; rows
    repeated whole give their places once, other rows of a repeated key all of theirs.
    """
    kind = docs.schema[key].dataType.simpleString()

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, kind, s + 1, e, float(score)) for k, t in zip(b["_k"], b["_t"]) for kind, s, e, score in find(t)]
            yield pd.DataFrame(rows, columns=[key, "kind", "start_pos", "end_pos", "score"])

    rows = docs.where(F.col(text).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("_k"), F.col(text).alias("_t"))
    return spread(rows).mapInPandas(scan, f"`{key}` {kind}, kind string, start_pos int, end_pos int, score double")


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with ``text`` redacted; every other column as it was, whatever its name."""

    @F.pandas_udf("string")
    def clean(t: pd.Series) -> pd.Series:
        return pd.Series([redact(x if isinstance(x, str) else None) for x in t], dtype=object)

    return spread(docs).withColumn(text, clean(F.col(text)))
