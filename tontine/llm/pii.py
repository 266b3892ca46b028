"""Personal data in texts, disguised forms included, with the offsets of the source.

Four kinds are found: e-mail addresses, IP addresses, card numbers (Luhn) and phone numbers. Plain ones are
matched on the source text as it is. Disguised ones are found by small transducers: each rewrites
a text and carries, for each character it writes, the source offsets that it stands for. Homoglyphs and
digits of other scripts become ASCII, invisible characters go, spelled digits become digits, and the
usual disguises of @ and the dot, in words, in brackets or as web pages escape them, become those marks. The same patterns then run on the rewritten text, and
what they find is mapped back. Only places that hold a disguise are rewritten. A disguised span that lies within
a plain one is dropped; one that reaches beyond it is added. Plain spans always stay. Redaction takes out the
union of spans that overlap.

Defined results: NULL text counts as empty and has no spans. Time grows linearly with a text's length. Rows
with the same id are searched each for itself; an empty table gives none. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tontine.llm.common import arrow_map, narrow

KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A match can only begin where a run of digits does, which keeps the search linear.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Look-alikes of ASCII characters in the Cyrillic and Greek scripts.
LOOKALIKES = dict(
    zip(
        "аеорсухіјѕһԁԛԝвмнткгАВЕЗКМНОРСТУХІЈЅ" "αορνικτυχεηωΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
        "aeopcyxijshdqwbmhtkrABE3KMHOPCTYXIJS" "aopvikтuxenwABEZHIKMNOPTYX".replace("т", "t"),
        strict=True,
    )
)
INVISIBLE = "­​‌‍⁠﻿"
DOTS = "․。．｡"
# The digits in words, from zero, in English, German, French and Spanish.
DIGIT_WORDS = (
    ("zero", "null", "zéro", "cero", "oh"),
    ("one", "eins", "un", "uno"),
    ("two", "zwei", "deux", "dos"),
    ("three", "drei", "trois", "tres"),
    ("four", "vier", "quatre", "cuatro"),
    ("five", "fünf", "cinq", "cinco"),
    ("six", "sechs", "seis"),
    ("seven", "sieben", "sept", "siete"),
    ("eight", "acht", "huit", "ocho"),
    ("nine", "neun", "neuf", "nueve"),
)
DIGIT_OF = {w: str(d) for d, words in enumerate(DIGIT_WORDS) for w in words}
_WORD = "|".join(sorted(DIGIT_OF, key=lambda w: (-len(w), w)))
_ITEM = rf"(?:{_WORD}|[0-9])"
#: Spelled digits in a row, four or more, with dots, and perhaps a plus before them.
SPELLED = re.compile(rf"(?i)(?<!\w)(?:(?:plus|\+)[ ]*)?{_ITEM}(?:[ ,()-]{{0,3}}(?:(?:dot|point|punkt|punto)[ ]+)?{_ITEM}){{6,}}(?!\w)")
_SPELLED_HINT = re.compile(rf"(?i)(?<!\w)(?:{_WORD})[ ,()-]{{1,3}}(?:(?:dot|point|punkt|punto)[ ]+)?(?:{_WORD}|[0-9])(?!\w)")
_SPELLED_ITEM = re.compile(rf"(?i)(plus)[ ]*|(dot|point|punkt|punto)[ ]*|({_WORD})|([0-9+])|([ ,()-]+)")
_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
AT = re.compile(rf"(?i)\s{{0,3}}{_OPEN}\s{{0,2}}(?:at|ät|@|arroba|arobase)\s{{0,2}}{_CLOSE}\s{{0,3}}")
DOT = re.compile(rf"(?i)\s{{0,3}}{_OPEN}\s{{0,2}}(?:dot|punkt|point|punto|\.)\s{{0,2}}{_CLOSE}\s{{0,3}}")
# The dot and the at sign in words, in English, German, French and Spanish.
_DOT_WORD, _AT_WORD = "(?:dot|punkt|point|punto)", "(?:at|ät|arobase|arroba)"
_SPOKEN_DOT = rf"\s+{_DOT_WORD}\s+"
#: Unbracketed words are read as marks only in the whole shape of an address.
SPOKEN = re.compile(
    rf"(?i)(?<![A-Za-z0-9._%+@-])([A-Za-z0-9_%+-]{{1,64}}(?:(?:\.|{_SPOKEN_DOT})[A-Za-z0-9_%+-]{{1,64}}){{0,4}})(\s+{_AT_WORD}\s+|\s*@\s*)([A-Za-z0-9-]{{1,63}})((?:(?:{_SPOKEN_DOT}|\.)[A-Za-z0-9-]{{1,63}}){{1,6}})(?![A-Za-z0-9-])"
)
_SPOKEN_HINT = re.compile(rf"(?i)\s{_DOT_WORD}\s|\s{_AT_WORD}\s+[a-z0-9-]+\.[a-z0-9]|\s@|@\s")
#: Four numbers with dots between them, of which one at least is a word.
SPOKEN_IP = re.compile(rf"(?i)(?<![\w.])[0-9]{{1,3}}(?:(?:\.|{_SPOKEN_DOT})[0-9]{{1,3}}){{3}}(?![0-9]|\.[0-9]|{_SPOKEN_DOT}[0-9])")
_DOT_WORDS, _AT_WORDS = ("dot", "punkt", "point", "punto"), ("at", "ät", "arobase", "arroba")
# The marks as web pages and addresses write them.
ESCAPES = re.compile(r"(?i)%40|%2e|&#0*(?:64|46);|&#x0*(?:40|2e);|&commat;|&period;")
# English words that are endings too; a spoken address isn't read into a sentence that goes on.
WORD_ENDINGS = frozenset("am as at be by do in is it me my no so to us".split())
_BRACKET_HINT = re.compile(rf"(?i){_OPEN}\s{{0,2}}(?:at|ät|@|arroba|arobase|dot|punkt|point|punto|\.)\s{{0,2}}{_CLOSE}")
# Endings that a wholly spoken address must have: the top-level domains (of countries first), those
# in ASCII code for other scripts (see ``ending``), and those reserved for examples.
ENDINGS = frozenset(
    """
    ac ad ae af ag ai al am ao aq ar as at au aw ax az ba bb be bf bg bh bi bj bm bn bo br bs bt bv bw by bz ca cc
    cd cf cg ch ci cl cm cn co cr cu cv cw cx cy cz de dj dk dm do dz ec ee eg es et eu fi fj fm fo fr ga gb gd ge
    gf gg gh gi gl gm gn gp gq gr gs gt gu gw gy hk hm hn hr ht hu id ie il im in io iq ir is it je jo jp ke kg ki
    km kn kp kr kw ky kz la lb lc li lk lr ls lt lu lv ly ma mc md me mg mh mk ml mn mo mp mq mr ms mt mu mv mw mx
    my mz na nc ne nf ng ni nl no nr nu nz om pa pe pf ph pk pl pm pn pr ps pt pw py qa re ro rs ru rw sa sb sc sd
    se sg sh si sj sk sl sm sn so sr ss st su sv sx sy sz tc td tf tg th tj tk tl tm tn to tr tt tv tw tz ua ug uk
    us uy uz va vc ve vg vi vn vu wf ws ye yt zm zw aaa aarp abarth abb abbott abbvie abc able abogado abudhabi
    academy accenture accountant accountants aco actor ads adult aeg aero aetna afl africa agakhan agency aig airbus
    airforce airtel akdn alfaromeo alibaba alipay allfinanz allstate ally alsace alstom amazon americanexpress
    americanfamily amex amfam amica amsterdam analytics android anquan anz aol apartments app apple aquarelle arab
    aramco archi army arpa art arte asda asia associates athleta attorney auction audi audible audio auspost author
    auto autos avianca aws axa azure baby baidu banamex bananarepublic band bank bar barcelona barclaycard barclays
    barefoot bargains baseball basketball bauhaus bayern bbc bbt bbva bcg bcn beats beauty beer bentley berlin best
    bestbuy bet bharti bible bid bike bing bingo bio biz black blackfriday blockbuster blog bloomberg blue bms bmw
    bnpparibas boats boehringer bofa bom bond boo book booking bosch bostik boston bot boutique box bradesco
    bridgestone broadway broker brother brussels build builders business buy buzz bzh cab cafe cal call calvinklein
    cam camera camp canon capetown capital capitalone car caravan cards care career careers cars casa case cash
    casino cat catering catholic cba cbn cbre cbs center ceo cern cfa cfd chanel channel charity chase chat cheap
    chintai christmas chrome church cipriani circle cisco citadel citi citic city cityeats claims cleaning click
    clinic clinique clothing cloud club clubmed coach codes coffee college cologne com comcast commbank community
    company compare computer comsec condos construction consulting contact contractors cooking cookingchannel cool
    coop corsica country coupon coupons courses cpa credit creditcard creditunion cricket crown crs cruise cruises
    cuisinella cymru cyou dabur dad dance data date dating datsun day dclk dds deal dealer deals degree delivery
    dell deloitte delta democrat dental dentist desi design dev dhl diamonds diet digital direct directory discount
    discover dish diy dnp docs doctor dog domains dot download drive dtv dubai dunlop dupont durban dvag dvr earth
    eat eco edeka edu education email emerck energy engineer engineering enterprises epson equipment ericsson erni
    esq estate etisalat eurovision eus events example exchange expert exposed express extraspace fage fail fairwinds
    faith family fan fans farm farmers fashion fast fedex feedback ferrari ferrero fiat fidelity fido film final
    finance financial fire firestone firmdale fish fishing fit fitness flickr flights flir florist flowers fly foo
    food foodnetwork football ford forex forsale forum foundation fox free fresenius frl frogans frontdoor frontier
    ftr fujitsu fun fund furniture futbol fyi gal gallery gallo gallup game games gap garden gay gbiz gdn gea gent
    genting george ggee gift gifts gives giving glass gle global globo gmail gmbh gmo gmx godaddy gold goldpoint
    golf goo goodyear goog google gop got gov grainger graphics gratis green gripe grocery group guardian gucci guge
    guide guitars guru hair hamburg hangout haus hbo hdfc hdfcbank health healthcare help helsinki here hermes hgtv
    hiphop hisamitsu hitachi hiv hkt hockey holdings holiday homedepot homegoods homes homesense honda horse
    hospital host hosting hot hoteles hotels hotmail house how hsbc hughes hyatt hyundai ibm icbc ice icu ieee ifm
    ikano imamat imdb immo immobilien inc industries infiniti info ing ink institute insurance insure int
    international intuit invalid investments ipiranga irish ismaili ist istanbul itau itv jaguar java jcb jeep jetzt
    jewelry jio jll jmp jnj jobs joburg jot joy jpmorgan jprs juegos juniper kaufen kddi kerryhotels kerrylogistics
    kerryproperties kfh kia kids kim kinder kindle kitchen kiwi koeln komatsu kosher kpmg kpn krd kred kuokgroup
    kyoto lacaixa lamborghini lamer lancaster lancia land landrover lanxess lasalle lat latino latrobe law lawyer
    lds lease leclerc lefrak legal lego lexus lgbt lidl life lifeinsurance lifestyle lighting like lilly limited
    limo lincoln linde link lipsy live living llc llp loan loans locker locus loft lol london lotte lotto love lpl
    lplfinancial ltd ltda lundbeck luxe luxury macys madrid maif maison makeup man management mango map market
    marketing markets marriott marshalls maserati mattel mba mckinsey med media meet melbourne meme memorial men
    menu merckmsd miami microsoft mil mini mint mit mitsubishi mlb mls mma mobi mobile moda moe moi mom monash money
    monster mormon mortgage moscow moto motorcycles mov movie msd mtn mtr museum music mutual nab nagoya name natura
    navy nba nec net netbank netflix network neustar new news next nextdirect nexus nfl ngo nhk nico nike nikon
    ninja nissan nissay nokia northwesternmutual norton now nowruz nowtv nra nrw ntt nyc obi observer office okinawa
    olayan olayangroup oldnavy ollo omega one ong onion onl online ooo open oracle orange org organic origins osaka
    otsuka ott ovh page panasonic paris pars partners parts party passagens pay pccw pet pfizer pharmacy phd philips
    phone photo photography photos physio pics pictet pictures pid pin ping pink pioneer pizza place play
    playstation plumbing plus pnc pohl poker politie porn post pramerica praxi press prime pro prod productions prof
    progressive promo properties property protection pru prudential pub pwc qpon quebec quest racing radio read
    realestate realtor realty recipes red redstone redumbrella rehab reise reisen reit reliance ren rent rentals
    repair report republican rest restaurant review reviews rexroth rich richardli ricoh ril rio rip rocher rocks
    rodeo rogers room rsvp rugby ruhr run rwe ryukyu saarland safe safety sakura sale salon samsclub samsung sandvik
    sandvikcoromant sanofi sap sarl sas save saxo sbi sbs sca scb schaeffler schmidt scholarships school schule
    schwarz science scot search seat secure security seek select sener services ses seven sew sex sexy sfr shangrila
    sharp shaw shell shia shiksha shoes shop shopping shouji show showtime silk sina singles site ski skin sky skype
    sling smart smile sncf soccer social softbank software sohu solar solutions song sony soy spa space sport spot
    srl stada staples star statebank statefarm stc stcgroup stockholm storage store stream studio study style sucks
    supplies supply support surf surgery suzuki swatch swiss sydney systems tab taipei talk taobao target tatamotors
    tatar tattoo tax taxi tci tdk team tech technology tel temasek tennis test teva thd theater theatre tiaa tickets
    tienda tiffany tips tires tirol tjmaxx tjx tkmaxx tmall today tokyo tools top toray toshiba total tours town
    toyota toys trade trading training travel travelchannel travelers travelersinsurance trust trv tube tui tunes
    tushu tvs ubank ubs unicom university uno uol ups vacations vana vanguard vegas ventures verisign versicherung
    vet viajes video vig viking villas vin vip virgin visa vision viva vivo vlaanderen vodka volkswagen volvo vote
    voting voto voyage vuelos wales walmart walter wang wanggou watch watches weather weatherchannel webcam weber
    website wedding weibo weir whoswho wien wiki williamhill win windows wine winners wme wolterskluwer woodside
    work works world wow wtc wtf xbox xerox xfinity xihuan xin xxx xyz yachts yahoo yamaxun yandex yodobashi yoga
    yokohama you youtube yun zappos zara zero zip zone zuerich
    """.split()
)
STRANGE = re.compile(f"[{INVISIBLE}{DOTS}Ͱ-ԯ٠-٩۰-۹०-९⁰-ₜ①-⓿﹐-﹫！-～\U0001d400-\U0001d7ff]")
REACH = 160

Span = tuple[str, int, int]


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses. Each @ is looked at once, with what stands before it."""
    out, end, low = [], 0, 0
    at = text.find("@")
    while at >= 0:
        head = text[max(low, end) : at]
        start = at - (len(head) - len(head.rstrip(LOCAL)))
        if at >= end and start < at and (m := DOMAIN.match(text, at + 1)):
            end = m.end()
            out.append((start, end))
        low = at + 1
        at = text.find("@", low)
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def plain(text: str) -> list[Span]:
    """Undisguised spans, by kind and start."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in (x[-4:] if not x[:-4].strip("0") else "999" for x in m[0].split("."))):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


class Rewritten:
    """A text with, for each character, the source offsets it stands for."""

    def __init__(self, text: str, starts: list[int], ends: list[int]):
        self.text, self.starts, self.ends = text, starts, ends

    @classmethod
    def of(cls, source: str, first: int, last: int) -> Rewritten:
        return cls(source[first:last], list(range(first, last)), list(range(first + 1, last + 1)))

    def replaced(self, pieces: list[tuple[int, int, str]]) -> Rewritten:
        """With (first, last, new text) put in place, in order. New characters stand for all of the old."""
        if not pieces:
            return self
        text, starts, ends, at = [], [], [], 0
        for first, last, new in pieces:
            text.append(self.text[at:first])
            starts += self.starts[at:first]
            ends += self.ends[at:first]
            text.append(new)
            if new:
                starts += [self.starts[first]] * len(new)
                ends += [self.ends[last - 1]] * len(new)
            at = last
        text.append(self.text[at:])
        return Rewritten("".join(text), starts + self.starts[at:], ends + self.ends[at:])


def _ascii(c: str) -> str:
    if c in INVISIBLE:
        return ""
    if c in DOTS:
        return "."
    if c in LOOKALIKES:
        return LOOKALIKES[c]
    digit = unicodedata.decimal(c, None)
    if digit is not None:
        return str(digit)
    same = unicodedata.normalize("NFKC", c)
    return same if len(same) == 1 and same.isascii() else c


def unmask_characters(r: Rewritten) -> Rewritten:
    return r.replaced([(m.start(), m.end(), new) for m in STRANGE.finditer(r.text) if (new := _ascii(m[0])) != m[0]])


def unmask_marks(r: Rewritten) -> Rewritten:
    at_sign = ("%40", "64;", "x40;", "commat;")
    r = r.replaced([(m.start(), m.end(), "@" if m[0].lower().endswith(at_sign) else ".") for m in ESCAPES.finditer(r.text)])
    r = r.replaced([(m.start(), m.end(), "@") for m in AT.finditer(r.text)])
    return r.replaced([(m.start(), m.end(), ".") for m in DOT.finditer(r.text)])


def ending(word: str) -> bool:
    """Whether an address can end so."""
    return word in ENDINGS or word.startswith("xn--")


def unmask_spoken(r: Rewritten) -> Rewritten:
    pieces = []
    for m in SPOKEN.finditer(r.text):
        spoken_at, spoken_dot = "@" not in m[2], re.search(r"\s", m[4])
        last = re.split(r"\.|\s+", m[4])[-1].lower()
        if spoken_at and not spoken_dot and not (re.search(r"[0-9._+]", m[1]) and re.search("[A-Za-z]", m[1])):
            continue  # "seen at example.com"
        if (spoken_at or spoken_dot) and not ending(last):
            continue
        goes_on = re.match(r"\s+[a-z]", r.text[m.end() : m.end() + 9])
        if spoken_at and last in WORD_ENDINGS and goes_on and not re.search(r"[0-9._%+-]", m[1]):
            continue  # "meet me at home dot in the park"
        for g, new in ((1, None), (2, "@"), (4, None)):
            if new:
                pieces.append((m.start(g), m.end(g), new))
            else:
                pieces += [(m.start(g) + d.start(), m.start(g) + d.end(), ".") for d in re.finditer(rf"(?i){_SPOKEN_DOT}", m[g])]
    return r.replaced(pieces)


def unmask_spoken_numbers(r: Rewritten) -> Rewritten:
    pieces = []
    for m in SPOKEN_IP.finditer(r.text):
        if re.search(rf"(?i)[0-9](?:\.|{_SPOKEN_DOT})\Z", r.text[max(0, m.start() - 24) : m.start()]):
            continue  # the end of a longer row of numbers
        pieces += [(m.start() + d.start(), m.start() + d.end(), ".") for d in re.finditer(rf"(?i){_SPOKEN_DOT}", m[0])]
    return r.replaced(pieces)


def unmask_digits(r: Rewritten) -> tuple[Rewritten, list[tuple[int, int]]]:
    """Spelled digits as digits; and the runs, which may be phone numbers without a plus."""
    pieces, runs, moved = [], [], 0
    for m in SPELLED.finditer(r.text):
        items = list(_SPELLED_ITEM.finditer(m[0]))
        if sum(bool(i[3]) for i in items) < 4:
            continue
        new = "".join("+" if i[1] else "." if i[2] else DIGIT_OF[i[3].lower()] if i[3] else i[4] or "" for i in items)
        pieces.append((m.start(), m.end(), new))
        runs.append((m.start() + moved, m.start() + moved + len(new)))
        moved += len(new) - (m.end() - m.start())
    return r.replaced(pieces), runs


def _between_digits(flat: str, word: str) -> bool:
    at = flat.find(word)
    while at >= 0:
        if flat[at - 1 : at].isdigit() and flat[at + len(word) : at + len(word) + 1].isdigit():
            return True
        at = flat.find(word, at + 1)
    return False


def _hints(text: str) -> list[re.Pattern]:
    """The disguises that the text can hold at all, by plain searches that cost little."""
    words = text.lower().replace(",", " ").replace("-", " ").split()
    flat = " ".join(words)
    out = []
    if any(c in text for c in "[({<") and _BRACKET_HINT.search(text):
        out.append(_BRACKET_HINT)
    # The words for a dot count only near a word for the at sign or between digits: "point" alone is common prose.
    dots = [f" {w} " for w in _DOT_WORDS if f" {w} " in flat]
    if dots and ("@" in text or any(f" {w} " in flat for w in _AT_WORDS) or any(_between_digits(flat, w) for w in dots)):
        out.append(_SPOKEN_HINT)
    elif "@ " in flat or " @" in flat or any(
        "." in t.split(" ", 1)[0].strip(".") for w in _AT_WORDS if f" {w} " in flat for t in flat.split(f" {w} ")[1:]
    ):
        out.append(_SPOKEN_HINT)
    if ("%" in text or "&" in text) and ESCAPES.search(text):
        out.append(ESCAPES)
    if sum(map(DIGIT_OF.__contains__, words)) >= 4:
        out.append(_SPELLED_HINT)
    if not text.isascii() and STRANGE.search(text):
        out.append(STRANGE)
    return out


def windows(text: str) -> list[tuple[int, int]]:
    """The places that hold a disguise, with room for an identifier around each."""
    spots = []
    for hint in _hints(text):
        spots += [(max(0, m.start() - REACH), min(len(text), m.end() + REACH)) for m in hint.finditer(text)]
    out: list[tuple[int, int]] = []
    for a, b in sorted(spots):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def disguised(text: str, taken: list[Span]) -> list[Span]:
    """Spans that only the rewritten text shows and that lie within none of ``taken``, nor of each other."""
    busy = [(a, b) for _, a, b in taken]
    found: list[Span] = []
    for first, last in windows(text):
        r = unmask_marks(unmask_characters(Rewritten.of(text, first, last)))
        r, runs = unmask_digits(unmask_spoken_numbers(unmask_spoken(r)))
        if r.text == text[first:last]:
            continue
        some = plain(r.text)
        for a, b in runs:
            if re.fullmatch("[0-9]+", r.text[a:b]) and 9 <= b - a <= 11:
                some.append(("phone", a, b))
        for kind, a, b in some:
            span = (kind, min(r.starts[a:b]), max(r.ends[a:b]))
            if r.text[a:b] == text[span[1] : span[2]]:
                continue  # not disguised: the window may have cut it from a longer match
            if any(x <= span[1] and span[2] <= y for x, y in busy):
                continue
            busy.append(span[1:])
            found.append(span)
    return found


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; spans that overlap are replaced as one, by the
    kind of the first."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if b <= at:
            continue
        out += [text[at : max(a, at)], f"[{kind.upper()}]"] if a >= at else []
        at = b
    return "".join(out) + text[at:]


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone`` (plain spans), ``n_added`` (disguised ones), ``base_sha256``
    (of the plain spans), ``spans`` (all) and, on request, the redacted text."""

    def search(columns):
        out = {k: [] for k in ("doc_id", *(f"n_{k}" for k in KINDS), "n_added", "base_sha256", "spans", "redacted")}
        for key, text in zip(columns["id"], columns["text"], strict=True):
            base = plain(text)
            more = disguised(text, base)
            out["doc_id"].append(key)
            for kind in KINDS:
                out[f"n_{kind}"].append(sum(k == kind for k, *_ in base))
            out["n_added"].append(len(more))
            out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
            out["spans"].append(joined(base + more))
            if with_text:
                out["redacted"].append(redacted(text, base + more))
        return out

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    schema = f"doc_id long, {counts}, n_added long, base_sha256 string, spans string" + ", redacted string" * with_text
    return arrow_map(narrow(docs, id_col, text_col), schema, search)


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The rows with all their columns, the text redacted (NULL stays NULL) and its length set anew."""
    from pyspark.sql.functions import pandas_udf

    from tontine.llm.common import ship

    ship(docs.sparkSession)

    @pandas_udf("string")
    def clean(texts):
        return texts.map(lambda t: None if t is None else redacted(t, (base := plain(t)) + disguised(t, base)))

    out = docs.withColumn(text_col, clean(F.col(text_col)))
    return out.withColumn(length_col, F.length(text_col).cast("long")) if length_col in docs.columns else out
