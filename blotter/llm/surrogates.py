"""Personal data replaced by keyed surrogates of the same type, in built-in functions only.

Detected entities (mail addresses, telephone, card and social-security numbers, IBANs, IPv4
addresses, access keys, secrets in assignments, hexadecimal tokens, and names after a title or
a known given name, and then those names alone in the same document) become units ``(kind, canonical form)``.  A unit's surrogate is a function of
the key, the unit and an attempt number: characters are replaced inside their class (digit,
hexadecimal, letter of the same script), prefixes that carry the type stay, a valid card number
stays valid, given names keep their gender and names their script.  Mentions take the surrogate in
their own format and letter case, so all mentions of an entity agree.

Attempts are raised until no two units of a kind share a surrogate and no surrogate is itself
a unit of the table: distinct entities stay distinct, and nobody's data is put in for another's.
Only documents with an entity are joined with the units' surrogates; the others pass by.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blotter.llm.common import Scratch, table

#: The session's setting that holds the secret key, and the key of demonstrations and tests without one.
KEY_SETTING = "spark.blotter.surrogates.key"
DEMO_KEY = "demonstration only"
#: Attempts after which a kind counts as one that has no surrogate left.
ATTEMPTS = 64

# fixed values: given names that surrogates are taken from
GIVEN_MALE = ("James", "Robert", "Michael", "William", "David", "Joseph", "Charles", "Daniel", "Matthew", "Mark",
              "Paul", "Kevin", "George", "Edward", "Brian", "Ronald", "Jacob", "Gary", "Frank", "Gregory")
GIVEN_FEMALE = ("Patricia", "Jennifer", "Elizabeth", "Barbara", "Susan", "Jessica", "Karen", "Nancy", "Margaret",
                "Sandra", "Emily", "Michelle", "Carol", "Amanda", "Deborah", "Rebecca", "Sharon", "Cynthia", "Kathleen",
                "Angela")
# given names that mark a name without a title, besides those
MORE_MALE = tuple((
    "Aaron Abdul Adam Ahmed Alan Albert Alejandro Alexander Alexandre Alfred Ali Andre Andreas Andrew Anthony Antoine Antonio "
    "Arthur Benjamin Bernard Bernd Bradley Brandon Bruce Bruno Bryan Carl Carlos Christian Christopher Craig Dennis Diego "
    "Dieter Dmitri Donald Douglas Dylan Edgar Eduardo Emilio Enrique Eric Ernest Ethan Eugene Felix Fernando Francisco "
    "Francois François Frederick Friedrich Gabriel Gerald Gerhard Giovanni Giuseppe Günter Hans Harold Harry Hassan Heinrich Helmut "
    "Henri Henry Howard Hugo Hussein Ian Ibrahim Igor Isaac Ivan Jack Jason Javier Jean Jeffrey Jeremy Jerome Jerry Jesse "
    "Jesus Joachim Johann Johannes John Jonathan Jorge Jose José Joshua Juan Julian Jürgen Karl Keith Kenneth Klaus Kurt "
    "Kyle Larry Lawrence Leonard Louis Luca Lucas Luigi Luis Manuel Marco Marcus Mario Martin Maurice Maximilian Miguel Mohamed "
    "Mohammed Muhammad Nathan Nicholas Nicolas Noah Oliver Omar Oscar Pablo Pascal Patrick Pedro Peter Philip Philippe Phillip "
    "Pierre Rafael Ralph Raymond Ricardo Richard Roberto Roger Roland Roy Russell Ryan Salvatore Samuel Scott Sean "
    "Sebastian Sergei Sergio Stefan Stephen Steven Stuart Terry Theodore Thomas Timothy Tyler Victor Vincent Vladimir "
    "Walter Wayne Werner Wilhelm Wolfgang Yusuf Zachary Александр Алексей Андрей Борис Владимир Дмитрий Иван Игорь Михаил "
    "Николай Олег Павел Петр Пётр Сергей Юрий Γιώργος Γεώργιος Γιάννης Ιωάννης Δημήτρης Κώστας Νίκος Νικόλαος").split())
MORE_FEMALE = tuple((
    "Abigail Adriana Agnes Aisha Alejandra Alexandra Alexis Alice Alicia Alison Amelia Amy Ana Andrea Anita Ann Anna Anne "
    "Annette Antonia Ashley Audrey Beatrice Beatriz Bernadette Beth Betty Beverly Birgit Brenda Brigitte Camille Carla Carmen "
    "Caroline Catherine Cecilia Charlotte Cheryl Chiara Christina Christine Clara Claudia Colette Danielle Debra Denise "
    "Diana Diane Donna Doris Dorothy Elaine Elena Eleanor Elisabeth Ella Ellen Elsa Emma Erika Esther Eva Evelyn Fatima "
    "Fiona Frances Francesca Gabriela Gabriele Giulia Gisela Gloria Hannah Heather Heidi Helen Helena Helga Ines Ingrid Irene "
    "Irina Isabel Isabella Jacqueline Jane Janet Janice Jean-Marie Joan Joanna Johanna Josephine Juana Judith Judy Julia "
    "Juliana Julie Karin Katharina Katherine Kathryn Katja Kelly Kimberly Laura Lauren Leila Leticia Lillian Linda Lisa Lori "
    "Louise Lucia Lucy Luisa Luise Madeleine Madison Magdalena Maria María Mariam Marie Marilyn Marina Martha Martina Mary "
    "Megan Melissa Mercedes Mildred Monica Monika Monique Nadia Natalia Natalie Nathalie Nicole Nina Noemi Olga Olivia "
    "Pamela Paula Pauline Petra Phyllis Pilar Rachel Raquel Regina Renate Rita Rosa Ruth Sabine Sabrina Samantha Sara Sarah "
    "Shirley Silvia Simone Sofia Sonia Sophia Sophie Stephanie Svetlana Sylvia Tamara Tanja Tatiana Teresa Theresa Tiffany "
    "Ursula Valentina Valerie Vanessa Veronica Victoria Virginia Wendy Yolanda Yvonne Zoe Александра Анастасия Анна Валентина "
    "Галина Екатерина Елена Ирина Мария Марина Наталья Ольга Светлана Татьяна Юлия Αικατερίνη Ελένη Κατερίνα Μαρία Σοφία").split())
TITLES_MALE = ("Mr", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Signor", "Господин", "Κύριος")
TITLES_FEMALE = ("Mrs", "Ms", "Miss", "Mme", "Mlle", "Lady", "Frau", "Fräulein", "Madame", "Mademoiselle", "Señora", "Señorita",
                 "Signora", "Госпожа", "Κυρία")
TITLES = ("Dr", "Prof", "Rev", "Doctor", "Professor", "Doktor", "Docteur", "Professeur", "Profesor", "Profesora", "Доктор",
          "Профессор", "Δρ")  # of both
FAMILY = ("Walker", "Bennett", "Carver", "Dalton", "Ellison", "Fletcher", "Grady", "Holloway", "Jensen", "Keller",
          "Lambert", "Mercer", "Norwood", "Osborne", "Prescott", "Quigley", "Radford", "Sawyer", "Tilden", "Vaughn")

#: What stands before a secret belongs to the mention, and stays.  A number near the word for a card takes the
#: blank before it along, which tells it from other long numbers: those need a check digit.
_SECRET = r"(?i:password|passwd|secret|token|api.?key)[\w-]*+[\"']?\s*+[=:]\s*+[\"']?"
_BEARER = r"(?i:bearer)\s++"
_HEAD = r"^(?:" + _SECRET + "|" + _BEARER + r"|[\s;,:](?=\d))"
_CARD = r"\d(?:[ -]?\d){12,18}(?!\d)"
_CARD_WORD = r"(?<=(?i:card|karte|carte|tarjeta|visa)[^\n]{0,60})"
_PHONE_WORD = r"(?<=(?i:phone|tel|tél|call|mobile|fax|handy)[^\d\n]{0,12})"
_GROUP = "[0-9A-Fa-f]{1,4}"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_PART = r"(?:['’-](?![sS](?!\p{L}))\p{L}++)"  # without a genitive's end
_NAME = r"\p{Lu}(?=[\p{L}'’-])\p{L}*+(?:" + _PART + r"{8}[\p{L}'’-]*+|" + _PART + "{0,7})"
_SEP = r"[ .-]?"
_TITLE = r"(?:Mr|Mrs|Ms|Mme|Mlle|Dr|Prof|Rev|Δρ)\.? |(?:" + "|".join(TITLES_MALE + TITLES_FEMALE + TITLES) + ") "


def _one_of(names: tuple[str, ...]) -> str:
    """A pattern of the names, by first letter."""
    firsts = sorted({n[0] for n in names})
    return "(?:" + "|".join(c + "(?:" + "|".join(n[1:] for n in names if n[0] == c) + ")" for c in firsts) + ")"


_GIVEN = _one_of(GIVEN_MALE + GIVEN_FEMALE + MORE_MALE + MORE_FEMALE)
#: alternatives are tried at every character, so each begins with a cheap test of the next one
PATTERN = "|".join((
    r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?=\.[\p{L}\p{N}-])[\p{L}\p{N}.-]*[\p{L}\p{N}]",
    r"(?=AKIA)(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])",
    r"(?=[pPsStTaA])" + _SECRET + r"(?=[+/_-]*+[A-Za-z0-9])[A-Za-z0-9+/_-]{8,}+(?![\w.%+-]*+@)",
    r"(?=[bB])" + _BEARER + r"(?=[A-Za-z+/_.=-]*+\d)[A-Za-z0-9+/_.=-]{8,}+",
    r"(?=[0-9a-f]{32})(?<![A-Za-z0-9])[0-9a-f]{32,}+(?![A-Za-z0-9])",
    r"(?=[0-9+(])(?:" + "|".join((
        r"(?<![\d.])" + _OCTET + r"(?:\." + _OCTET + r"){3}(?!\.?\d)",
        r"(?<!\d)\d{3}-\d{2}-\d{4}(?![\d-])",
        r"(?<![\w+])\+\d{1,3}" + _SEP + r"\(?\d{2,4}\)?" + _SEP + r"\d{2,4}(?:" + _SEP + r"\d{2,4}){1,3}(?!\d)",
        r"(?<![\w(])\(\d{3}\) ?\d{3}-\d{4}(?!\d)",
        r"(?<![\w-])\d{3}-\d{3}-\d{4}(?![\d-])",
        r"(?<![\w.-])" + _PHONE_WORD + r"(?:\d{10}|\d{3} \d{3} \d{4})(?![\d-])",
        r"(?<![\w.:])" + _CARD)) + ")",
    r"(?=[\s;,:]\d)" + _CARD_WORD + r"[\s;,:]" + _CARD,
    r"(?=" + _GROUP + r":)(?<![\w:.])(?:(?:" + _GROUP + ":){7}" + _GROUP + "|(?:" + _GROUP + ":){2,6}(?::" + _GROUP
    + r"){1,5})(?![\w:])",
    r"(?=[A-Z]{2}\d)(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    r"(?=\p{Lu}\p{L})(?<!\p{L})(?:" + _TITLE + "){1,3}" + _NAME + "(?: " + _NAME + ")?",
    r"(?=\p{Lu}[\p{L}-]+ \p{Lu})(?<!\p{L})" + _GIVEN + " " + _NAME,
))
#: what some pattern needs, cheap to look for: most texts pass by
_HINT = r"[0-9@=:]|\p{Lu}(?:KIA|(?:r|rs|s|me|lle|rof|ev)\. \p{Lu}|[\p{Ll}-]+ \p{Lu})|Δρ\. "
_TITLE_END = "^(?:" + _TITLE + "){1,3}"

_ALPHABETS = (("[0-9]", "0123456789"), ("[a-z]", "abcdefghijklmnopqrstuvwxyz"), ("[A-Z]", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
              ("[а-я]", "абвгдежзийклмнопрстуфхцчшщыэюя"), ("[А-Я]", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЫЭЮЯ"),
              ("[α-ω]", "αβγδεζηθικλμνξοπρστυφχψω"), ("[Α-Ω]", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"),
              (r"[\x{00DF}-\x{00FF}]", "àáâäçèéêëìíîïñòóôöùúûü"), (r"[\x{00C0}-\x{00DE}]", "ÀÁÂÄÇÈÉÊËÌÍÎÏÑÒÓÔÖÙÚÛÜ"),
              (r"\p{IsCyrillic}", "абвгдежзийклмнопрстуфхцчшщыэюя"), (r"\p{IsGreek}", "αβγδεζηθικλμνξοπρστυφχψω"),
              (r"\p{IsHan}", "安白北成川大东方风高光海和华家江金开林明南平青山石天文新云中"),
              (r"\p{IsHiragana}", "あいうえおかきくけこさしすせそたちつてとなにぬねの"),
              (r"\p{IsKatakana}", "アイウエオカキクケコサシスセソタチツテトナニヌネノ"),
              (r"\p{IsHangul}", "가나다라마바사아자차카타파하고노도로모보소오"),
              (r"\p{IsArabic}", "ابتثجحخدذرزسشصضطظعغفقكلمنهوي"), (r"\p{IsHebrew}", "אבגדהוזחטיכלמנסעפצקרשת"),
              (r"\p{IsDevanagari}", "अआइईउकखगघचछजटडतदनपबमयरलवसह"), (r"\p{IsThai}", "กขคงจชซดตทนบปพมยรลวสหอ"),
              (r"\p{N}", "0123456789"), (r"\p{L}", "abcdefghijklmnopqrstuvwxyz"))  # of any other script
_HEX = (("[0-9a-f]", "0123456789abcdef"),)
#: syllables of made-up names by script, and their endings: male, female, family
_SYLLABLES = {"latin": ("ba be di do fa ga he jo ka le li ma mo na ne pa ra ro sa se ta te ti va ve vi wa we zo ly",
                        ("n", "na", "r")),
              "cyrillic": ("ба бе ди до фа га ве жо ка ле ли ма мо на не па ра ро са се та те ти ва вы ви ха зе зо лу",
                           ("н", "на", "ров")),
              "greek": ("βα βε δι δο φα γα χε κο κα λε λι μα μο να νε πα ρα ρο σα σε τα τε τι ζα ζε ζι θα θε ξο λυ",
                        ("ς", "να", "ης"))}


def _lit(text: str) -> Column:
    return F.lit(text)


def _hmac(key: str, *parts: Column) -> Column:
    """HMAC-SHA-512 of the parts under the key, as hexadecimal digits."""
    raw = key.encode()
    block = (hashlib.sha512(raw).digest() if len(raw) > 128 else raw).ljust(128, b"\0")
    inner, outer = (F.lit(bytes(b ^ pad for b in block)) for pad in (0x36, 0x5C))
    message = F.concat_ws("\x1f", *parts).cast("binary")
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, message), 512))), 512)


def _number(digest: Column, i: Column) -> Column:
    """A number below 4096 from the digest, for position ``i`` (from 0)."""
    return F.conv(F.substring(digest, F.pmod(i * 3, F.lit(126)).cast("int") + 1, F.lit(3)), 16, 10).cast("int")


def _mapped(text: Column, digest: Column, alphabets=_ALPHABETS, keep: int = 0) -> Column:
    """Each character after the first ``keep`` replaced by one of its own class."""
    def letters(c: Column) -> Column:
        out = None
        for cls, some in alphabets:
            out = F.when(c.rlike(cls), some) if out is None else out.when(c.rlike(cls), some)
        return F.struct(c.alias("c"), out.alias("letters"))

    def one(u: Column, at: Column) -> Column:
        spot = (_number(digest, at + 1) % F.length(u["letters"]) + 1).cast("int")
        return F.when((at < keep) | u["letters"].isNull(), u["c"]).otherwise(F.substring(u["letters"], spot, F.lit(1)))

    return F.array_join(F.transform(F.transform(F.split(text, ""), letters), one), "")


def _luhn_sum(digits: Column) -> Column:
    """Sum of the digits, every second one from the right (the last is first) doubled."""
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when((F.length(digits) - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)


def _card(digits: Column, digest: Column) -> Column:
    fresh = _mapped(digits, digest, keep=1)
    body = F.substring(fresh, F.lit(1), F.length(digits) - 1)
    check = F.pmod(10 - _luhn_sum(F.concat(body, _lit("0"))) % 10, F.lit(10))
    return F.when(_luhn_sum(digits) % 10 == 0, F.concat(body, check.cast("string"))).otherwise(fresh)


def _script(token: Column) -> Column:
    return F.when(token.rlike(r"\p{IsCyrillic}"), "cyrillic").when(token.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _name(kind: Column, token: Column, digest: Column, attempt: Column) -> Column:
    """A name of the kind in the token's script: a common one at first (Latin), then made up."""
    pick = lambda names: F.element_at(F.array(*map(_lit, names)), _number(digest, F.lit(0)) % len(names) + 1)
    common = (F.when(kind == "given_male", pick(GIVEN_MALE)).when(kind == "given_female", pick(GIVEN_FEMALE))
              .otherwise(pick(FAMILY)))
    made = None
    for script, (syllables, ends) in _SYLLABLES.items():
        parts = F.split(_lit(syllables), " ")
        body = F.array_join(F.transform(F.sequence(F.lit(1), 2 + attempt), lambda i: F.element_at(
            parts, _number(digest, i) % 30 + 1)), "")
        end = F.when(kind == "given_male", ends[0]).when(kind == "given_female", ends[1]).otherwise(ends[2])
        name = F.initcap(F.concat(body, end))
        made = name if made is None else F.when(_script(token) == script, name).otherwise(made)
    return F.when((attempt == 0) & (_script(token) == "latin"), common).otherwise(made)


def surrogate(kind: Column, unit: Column, attempt: Column, key: str) -> Column:
    """The surrogate of a unit at an attempt, in canonical form."""
    host = _host(unit)
    return _let(_hmac(key, kind, unit, attempt.cast("string")), lambda digest: _let(
        _hmac(key, _lit("domain"), host), lambda of_domain: _surrogate(kind, unit, attempt, digest, of_domain)))


def _host(unit: Column) -> Column:
    """A mail address's domain without its last label."""
    domain = F.substring_index(unit, "@", -1)
    return F.substring(domain, F.lit(1), F.length(domain) - F.length(F.substring_index(domain, ".", -1)) - 1)


def _let(value: Column, expression) -> Column:
    """``expression(value)`` with the value computed once, though functions of an array's elements use it."""
    return F.get(F.transform(F.array(value), expression), F.lit(0))


def _surrogate(kind: Column, unit: Column, attempt: Column, digest: Column, of_domain: Column) -> Column:
    host, labels = _host(unit), F.substring_index(unit, ".", -1)
    # units of few letters get longer, so that later attempts cannot run out of surrogates
    more = _mapped(F.repeat(_lit("a"), F.floor(attempt / 4).cast("int")), F.reverse(digest))
    mail = F.concat(_mapped(F.substring_index(unit, "@", 1), digest), more, _lit("@"), _mapped(host, of_domain), _lit("."), labels)
    octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (
        _number(digest, i) % 254 + 1).cast("string")), ".")
    return (F.when(kind == "email", mail).when(kind == "ip", octets)
            .when(kind == "card", _card(unit, digest)).when(kind == "phone", _mapped(unit, digest, keep=1))
            .when(kind == "access_key", _mapped(unit, digest, keep=4)).when(kind == "iban", _mapped(unit, digest, keep=2))
            .when(kind.isin("hex", "ipv6"), _mapped(unit, digest, _HEX))
            .when(kind.isin("given_male", "given_female", "family"), _name(kind, unit, digest, attempt))
            .when(kind == "secret", F.concat(_mapped(unit, digest), more)).otherwise(_mapped(unit, digest)))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _body(m: Column) -> Column:
    """The mention without what stands before a secret or a card number."""
    return F.regexp_replace(m, _HEAD, "")


def _kind(mention: Column) -> Column:
    """The kind of a mention; ``number`` is a long number that is no card: it stays as it is."""
    return _let(_body(mention), lambda m: _kind_of(mention, m))


def _kind_of(mention: Column, m: Column) -> Column:
    card = (F.length(mention) > F.length(m)) | (_luhn_sum(_digits(m)) % 10 == 0)
    return (F.when(m.contains("@"), "email").when(m.rlike("^AKIA[0-9A-Z]{16}$"), "access_key")
            .when(m.rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$"), "ip").when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
            .when(m.rlike(r"^(?:\+\d|\(\d|\d{3}-\d{3}-\d{4}$|\d{10}$|\d{3} \d{3} \d{4}$)[\d .()-]*$")
                  & (F.length(_digits(m)) >= 7), "phone")
            .when(m.rlike(r"^\d(?:[ -]?\d){12,18}$"), F.when(card, "card").otherwise("number"))
            .when(m.rlike("^[0-9a-f]{8,}$"), "hex")
            .when(m.rlike(r"^[A-Z]{2}\d{2}[A-Z0-9 ]{12,}$"), "iban")
            .when(m.rlike("^[0-9A-Fa-f:]+$") & m.contains(":"), "ipv6")
            .when(m.rlike(r"^\p{Lu}[\p{Ll}-]+\.? \p{Lu}"), "person").otherwise("secret"))


def _male(m: Column) -> Column:
    """By the title, else by the given name."""
    own = F.regexp_replace(m, r"^(?:(?:" + "|".join(TITLES) + r")\.? )+", "")
    return own.rlike("^(?:" + "|".join(TITLES_MALE + GIVEN_MALE + MORE_MALE) + r")(?!\p{L})")


def _names(mentions: Column) -> Column:
    """The names in the mentions of persons, as units are written."""
    persons = F.filter(mentions, lambda m: _kind(m) == "person")
    return F.array_distinct(F.flatten(F.transform(persons, lambda m: F.transform(_units(m), lambda u: u["unit"]))))


def _following(names: Column) -> Column:
    """``PATTERN``, and after it the names alone: in any letter case, or with a capital first if they
    have fewer than four letters (``an`` and ``so`` are names, and words)."""
    ordered = F.sort_array(names, asc=False)  # a longer name before its beginning
    short = F.flatten(F.transform(F.filter(ordered, lambda n: F.length(n) < 4), lambda n: F.array(n, F.upper(n))))
    long_ = F.filter(ordered, lambda n: F.length(n) >= 4)
    part = lambda before, some: F.when(F.size(some) > 0, F.concat(
        _lit(before), F.array_join(some, "|"), _lit(")")))
    alone = F.concat_ws("|", part("(?iu:", long_), part("(?:", short))
    return F.concat(_lit(PATTERN + r"|(?<![\p{L}\p{N}_])(?:"), alone, _lit(r")(?![\p{L}\p{N}_])"))


def _alone(m: Column, names: Column) -> Column:
    """Whether a mention is one of the document's names without title or given name."""
    return F.array_contains(names, F.initcap(m))


def _units(m: Column) -> Column:
    """The units of a mention: one, for a person one for each name, for a plain number none."""
    names = F.split(F.regexp_replace(m, _TITLE_END, ""), " ")
    given = F.when(_male(m), "given_male").otherwise("given_female")
    person = F.transform(names, lambda n, i: F.struct(
        F.when((i == 0) & (F.size(names) > 1), given).otherwise("family").alias("kind"), F.initcap(n).alias("unit")))
    def of(kind: Column, body: Column) -> Column:
        unit = (F.when(kind.isin("email", "ipv6"), F.lower(body)).when(kind.isin("card", "phone", "ssn"), _digits(body))
                .when(kind == "iban", F.regexp_replace(body, " ", "")).otherwise(body))
        none = F.array().cast("array<struct<kind:string,unit:string>>")
        return (F.when(kind == "person", person).when(kind == "number", none)
                .otherwise(F.array(F.struct(kind.alias("kind"), unit.alias("unit")))))

    return _let(_body(m), lambda body: _let(_kind_of(m, body), lambda kind: of(kind, body)))


def _filled(m: Column, fresh: Column, holes: str) -> Column:
    """The mention with its characters of the class ``holes`` taken from ``fresh`` one by one (for
    short mentions: each character counts the holes before it)."""
    def one(i: Column) -> Column:
        c = F.substring(m, i, F.lit(1))
        nth = F.length(F.regexp_replace(F.substring(m, F.lit(1), i), f"[^{holes}]", ""))
        return F.when(c.rlike(f"[{holes}]"), F.substring(fresh, nth, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(m)), one), "")


def _in_case(m: Column, fresh: Column) -> Column:
    """``fresh`` in the mention's letter case, character by character in one pass; it may be longer."""
    pairs = F.arrays_zip(F.split(m, "").alias("old"), F.split(fresh, "").alias("new"))
    return F.array_join(F.transform(pairs, lambda p: F.when(p["old"].rlike(r"\p{Lu}"), F.upper(p["new"]))
                                    .otherwise(p["new"])), "")


def _written(m: Column, names: Column, fresh_of) -> Column:
    """The mention's replacement; ``fresh_of(kind, unit)`` looks a surrogate up."""
    unit = F.initcap(m)
    name = F.coalesce(*[fresh_of(_lit(k), unit) for k in ("family", "given_male", "given_female")])
    name = F.when(m == F.upper(m), F.upper(name)).when(m == F.lower(m), F.lower(name)).otherwise(name)
    return F.when(_alone(m, names), name).otherwise(_written_whole(m, fresh_of))


def _written_whole(m: Column, fresh_of) -> Column:
    def of(kind: Column, body: Column, units: Column, fresh: Column) -> Column:
        names = F.array_join(F.transform(units, lambda u: fresh_of(u["kind"], u["unit"])), " ")
        person = F.concat(F.regexp_extract(m, _TITLE_END, 0), names)
        return (F.when(kind == "person", F.when(m == F.upper(m), F.upper(person)).otherwise(person))
                .when(kind == "number", m)
                .otherwise(F.concat(F.regexp_extract(m, _HEAD, 0), F.when(
                    kind.isin("card", "phone", "ssn"), _filled(body, fresh, "0-9"))
                    .when(kind == "iban", _filled(body, fresh, "A-Z0-9"))
                    .when(kind == "email", _in_case(body, fresh)).otherwise(fresh))))

    first = lambda units: F.get(units, F.lit(0))
    return _let(_body(m), lambda body: _let(_kind_of(m, body), lambda kind: _let(_units(m), lambda units: _let(
        fresh_of(first(units)["kind"], first(units)["unit"]), lambda fresh: of(kind, body, units, fresh)))))


def _assigned(units: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """``kind, unit, fresh`` with collision-free surrogates for distinct units.

    Each round looks for units that must try again: of several with one surrogate all but the
    first (those settled earlier come first), and those whose surrogate is a unit of the table.
    Only the number of such units comes to the driver.  Each has surrogates beyond any number of attempts but
    for the kinds of fixed length; a table that holds nearly all numbers of a length has none left, which is
    an error after ``ATTEMPTS``.  Units are few bytes of costly work, so they are dealt over a given number of
    tasks, which Spark does not merge.
    """
    tasks = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    now = scratch.write(units.repartition(tasks, "kind", "unit").withColumn("attempt", F.lit(0))
                        .withColumn("fresh", surrogate(F.col("kind"), F.col("unit"), F.lit(0), key)))
    for _ in range(ATTEMPTS):
        rank = F.row_number().over(Window.partitionBy("kind", "fresh").orderBy("attempt", "unit"))
        own = units.select("kind", F.col("unit").alias("fresh"), F.lit(True).alias("taken"))
        marked = (now.withColumn("n", rank).join(own, ["kind", "fresh"], "left")
                  .withColumn("again", (F.col("n") > 1) | F.coalesce("taken", F.lit(False))))
        attempt = F.col("attempt") + F.col("again").cast("int")
        following = scratch.write(marked.select("kind", "unit", attempt.alias("attempt"), F.when(
            F.col("again"), surrogate(F.col("kind"), F.col("unit"), attempt, key)).otherwise(F.col("fresh")).alias("fresh"),
            "again"))
        open_ = following.where("again").groupBy("kind").count().collect()
        scratch.drop(now)
        now = following.drop("again")
        now._scratch_path = following._scratch_path
        if not open_:
            return now.select("kind", "unit", "fresh")
    raise ValueError("no surrogates are left for: " + ", ".join(f"{r['count']} of kind {r['kind']}" for r in open_))


def session_key(spark: SparkSession) -> str:
    """The key of the session's ``KEY_SETTING``; without one that of demonstrations."""
    return spark.conf.get(KEY_SETTING, None) or DEMO_KEY


def replace_personal_data(docs: DataFrame, key: str, entities: str | None = None) -> DataFrame:
    """All rows and columns of ``docs`` with the personal data in ``text`` replaced.

    ``key`` is a secret: whoever has it can tell whether a guess belongs to a surrogate (HMAC-SHA-512).  ``entities`` names a column to add (or to replace) with an array of ``kind, surrogate`` in
    text order.  A null text stays null; a text without an entity is unchanged to the byte.
    Repeated rows get equal texts and null ids are treated like any other; an empty table gives an
    empty one.  A text of any length is read whole, in time that grows with its length.  Of overlapping entities the
    one that begins first counts, of two at one place the first in ``PATTERN``.  Columns of any other name
    are carried along.
    """
    if not key:
        raise ValueError("surrogates need a secret key")
    scratch = Scratch(docs.sparkSession, "surrogates")
    names = docs.columns
    rest = F.struct(*[F.col(f"`{c}`") for c in names if c != "text"])
    held = docs.select(rest.alias("__row"), F.col("text").cast("string").alias("text"))
    hint = F.col("text").rlike(_HINT)
    mentions = F.regexp_extract_all("text", _lit(PATTERN), F.lit(0))
    found = scratch.write(
        held.where(hint).withColumn("first", mentions).where(F.size("first") > 0)
        .withColumn("id", F.sha2(F.concat_ws("\x1f", F.col("__row.doc_id").cast("string"), "text").cast("binary"), 256))
        .withColumn("names", _names(F.col("first"))))
    # a person found once is followed through the document
    named = F.size("names") > 0
    pattern = F.when(named, _following(F.col("names"))).otherwise(_lit(PATTERN))
    again = F.when(named, F.regexp_extract_all("text", pattern, F.lit(0))).otherwise(F.col("first"))
    touched = scratch.write(found.withColumn("mentions", again))
    whole = F.filter(F.col("mentions"), lambda m: ~_alone(m, F.col("names")))
    each = scratch.write(touched.select("id", F.explode(F.array_union("first", whole)).alias("mention"))
                         .select("id", F.explode(_units(F.col("mention"))).alias("u")).select("id", "u.kind", "u.unit").distinct())
    fresh = _assigned(each.select("kind", "unit").distinct(), key, scratch)
    place = F.concat_ws("\x1f", "kind", "unit")
    maps = (each.join(fresh, ["kind", "unit"]).groupBy("id")  # the units of one document
            .agg(F.map_from_entries(F.collect_list(F.struct(place, "fresh"))).alias("fresh")))

    look = lambda kind, unit: F.element_at(F.col("fresh"), F.concat_ws("\x1f", kind, unit))
    done = (touched.join(maps, "id", "left")  # a text may hold plain numbers alone
            .withColumn("new", F.transform("mentions", lambda m: _written(m, F.col("names"), look)))
            .withColumn("between", F.when(named, F.split("text", pattern, -1)).otherwise(F.split("text", PATTERN, -1))))
    joined = F.array_join(F.transform(F.sequence(F.lit(0), F.size("between") - 1), lambda i: F.concat(
        F.get("between", i), F.coalesce(F.get("new", i), _lit("")))), "")
    listed = F.transform("mentions", lambda m, i: F.struct(
        F.when(_alone(m, F.col("names")), "person").otherwise(_kind(m)).alias("kind"),
        F.regexp_replace(F.get("new", i), _HEAD, "").alias("surrogate")))
    listed = F.filter(listed, lambda e: e["kind"] != "number")
    done = done.select("__row", joined.alias("__text"), listed.alias("__list"))  # no name of docs among these
    empty = F.array().cast("array<struct<kind:string,surrogate:string>>")
    kept = held.where(~F.coalesce(hint & F.col("text").rlike(PATTERN), F.lit(False)))

    def columns(text: Column, list_: Column):
        out = [text.alias(c) if c == "text" else F.col(f"__row.`{c}`").alias(c) for c in names if c != entities]
        return out + ([list_.alias(entities)] if entities else [])

    kept = kept.select("__row", F.col("text").alias("__text"), empty.alias("__list"))
    return kept.select(*columns(F.col("__text"), F.col("__list"))).unionByName(done.select(*columns(F.col("__text"), F.col("__list"))))


def op2_surrogates(spark, sf_dir: str) -> DataFrame:
    """All documents with their personal data replaced, and what was put in."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = replace_personal_data(docs, session_key(spark), entities="entities")
    return done.select("doc_id", "text", F.size("entities").cast("long").alias("n_entities"),
                       F.array_join(F.transform("entities", lambda e: e["kind"]), ",").alias("kinds"))
