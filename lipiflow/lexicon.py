"""Word lists, patterns and maps.  All are fixed values: results depend on each of them as it stands."""

from __future__ import annotations

# Words that alone never make a name.
STOP_WORDS = (
    "का", "की", "के", "में", "से", "को", "और", "या", "है", "हैं", "था", "थी", "थे",
    "नाम", "पिता", "माता", "पुत्र", "पुत्री", "श्री", "श्रीमती", "जी", "साहब", "महोदय",
    "द्वारा", "तक", "बाद", "पहले", "साथ", "लिए", "अनुसार", "तरह", "रूप",
    "जन्म", "मृत्यु", "आयु", "उम्र", "वर्ष", "साल", "महीना", "दिन", "तारीख",
    "गांव", "शहर", "जिला", "राज्य", "देश", "पता", "मकान", "सड़क", "इलाका",
)
# Words that no name contains.
NOT_IN_NAMES = ("वर्ष", "साल", "दिन", "महीना", "जन्म", "मृत्यु")
# Parts that make a name more likely.
NAME_INDICATORS = ("श्री", "श्रीमती", "कुमार", "कुमारी", "डॉ", "प्रो", "मिस्टर", "मिसेज", "बेटा", "बेटी", "पुत्र", "पुत्री", "पति", "पत्नी", "माता", "पिता")

# Patterns over cleaned text.
UNWANTED = r"[^ऀ-ॿ\s\d.\-/()]+"
NAME = r"[ऀ-ॿ]+(?:\s+[ऀ-ॿ]+)*"
CONTEXT = r"(?:नाम|श्री|श्रीमती|कुमार|कुमारी)\s*:?\s*([ऀ-ॿ\s]+)"
KEY_VALUE = r"([ऀ-ॿ]+)\s*:?\s*([ऀ-ॿ\s\d\-/]+)"
AGE = r"(?:आयु|उम्र|वर्ष|साल)\s*:?\s*(\d+)"
DATE = r"(\d{1,2})[/\-](\d{1,2})[/\-](\d{2,4})"
LONE_PUNCTUATION = r"\s+[।,;.]+\s+"

# Clean-up of transliterated text, in this order, in either case.
NAMES_WITHOUT_A = ("Ram", "Shyam", "Mohan", "Krishna", "Geeta", "Sita", "Radha")
TRAILING_DOUBLES = ("aa", "ee", "ii", "oo", "uu")
MARKS = ("^", "~")

# The letters of the romanisation.  One letter for one:
LETTERS_FROM = "अआइईउऊएओािीुूेोकगजटडणतदनपबमयरलवसहंः०१२३४५६७८९।्"
LETTERS_TO = "aAiIuUeoAiIuUeokgjTDNtdnpbmyrlvshMH0123456789."  # the last, virama, goes
# and more for one:
LETTER_GROUPS = {
    "ख": "kh", "घ": "gh", "ङ": "~N", "च": "ch", "छ": "Ch", "झ": "jh", "ञ": "~n", "ठ": "Th", "ढ": "Dh", "थ": "th", "ध": "dh",
    "फ": "ph", "भ": "bh", "श": "sh", "ष": "Sh", "ऐ": "ai", "औ": "au", "ऋ": "ri", "ै": "ai", "ौ": "au", "ृ": "ri", "ँ": ".N",
}
# Letters with a nukta, composed and not, and what stands for them.
NUKTA = {"क़": "क", "ख़": "ख", "ग़": "ग", "ज़": "ज", "ड़": "ड", "ढ़": "ढ", "फ़": "फ", "य़": "य", "़": ""}

# Glyph numbers of broken fonts.
CID = {
    147: "क", 130: "ा", 154: "र", 3: " ", 152: "म", 157: "न", 545: "ा", 91: "ी",
    133: "व", 128: "त", 155: "ल", 547: "य", 15: "-", 20: "२", 18: "०", 21: "३",
    10: "(", 11: ")", 148: "प", 471: "ू", 468: "ज", 159: "श", 219: "ं", 289: "न",
    160: "स", 201: "ख", 232: "स", 272: "श", 230: "च", 162: "क", 92: "अ", 93: "आ",
    94: "इ", 95: "ई", 96: "उ", 135: "ऊ", 136: "ऋ", 139: "ठ", 144: "थ", 145: "द",
    146: "ध", 150: "ब", 153: "ल", 158: "व", 161: "ह", 200: "क्ष", 202: "छ",
    215: "त", 220: "प", 222: "ब", 224: "म", 227: "ल", 229: "श्", 231: "ष",
    234: "क", 282: "ट", 287: "य", 292: "प्र", 294: "ब्र", 302: "ट", 419: "न", 464: "र",
    467: "न", 469: "ु", 509: "नि", 510: "बि", 511: "दि", 546: "य", 554: "ह", 559: "े",
    560: "है", 566: "र्व", 581: "ें", 591: "न्", 622: "श", 668: "ा", 871: "सि", 873: "श्",
    874: "उ", 876: "ध",
}
# Repairs of broken letters and words, in this order.
REPAIRS = (
    ("ा ु", "ाु"), ("क ा", "का"), ("र ा", "रा"), ("म ा", "मा"), ("न ा", "ना"), ("त ा", "ता"),
    ("स ा", "सा"), ("ल ा", "ला"), ("प ा", "पा"), ("द ा", "दा"), ("ब ा", "बा"), ("ग ा", "गा"),
    ("ज ा", "जा"), ("च ा", "चा"), ("व ा", "वा"), ("श ा", "शा"), ("ह ा", "हा"), ("य ा", "या"),
    ("काु", "काु"), ("राजकाुमार", "राजकुमार"), ("राजक ाुमार", "राजकुमार"),
    ("चयाम", "श्याम"), ("प्रक ाा", "प्रकाश"), ("प्रकााश", "प्रकाश"),
    ("जयप्रक ाा", "जयप्रकाश"), ("जयप्रकााश", "जयप्रकाश"), ("मक ा", "मका"),
    ("कउन", "कुन"), ("कुनता", "कुन्ता"), ("बागू", "बाबू"), ("कशचचयन", "कृष्णा"),
    ("ठाक ाुर", "ठाकुर"), ("ठाकाुर", "ठाकुर"), ("मुक ाुल", "मुकुल"),
    ("मुकाुल", "मुकुल"), ("विनित", "विनीत"), ("सिसं", "सिंह"), ("सिलं", "सिंह"),
    ("श ्याम", "श्याम"), ("ग िता", "गीता"),
)
# Parts of surnames; the first word with one begins the relative's name.
SURNAMES = (
    "सिसंह", "सिंह", "कुमार", "प्रसाद", "लाल", "चंद", "देव", "राम", "शर्मा", "गुप्ता", "यादव", "पटेल", "वर्मा", "अग्रवाल",
    "शुक्ला", "पांडे", "मिश्रा", "तिवारी", "चौधरी", "जैन", "अग्निहोत्री", "द्विवेदी", "त्रिपाठी", "उपाध्याय",
)
# Words dropped from a voter's name.
NOT_NAMES = ("पुत्र", "पत्नी", "पति", "स/ो", "डब्ल्यू/ओ", "पिता", "का", "की", "के")
# Clean-up of a voter's romanised name, in this order.
ROLL_RULES = (
    ("aa", "a"), ("ii", "i"), ("ee", "e"), ("oo", "o"), ("uu", "u"), ("~n", "n"), ("'", ""), (r"\.h", "h"), (r"\.n", "n"),
    (r"\.m", "m"), (r"\.t", "t"), (r"\.d", "d"), ("~", ""), ("asha$", "ash"), ("ata$", "at"), ("ana$", "an"),
)
# Fields of a roll page's header; the field is group 1.
HEADER = {
    "district": r"(\d{2,3}[- ]?[A-Za-zअ-ह]+)",
    "bodyNumber": r"(\d+-[A-Za-zअ-ह]+)",
    "ward": r"वार्ड[: ]?(\d+-?[A-Za-zअ-ह]+)",
    "pollingCenter": r"केंद्र[: ]?([A-Za-zअ-ह ]+)",
    "partNumber": r"भाग[: ]?(\d+)",
    "roomNumber": r"कक्ष[: ]?(\d+)",
    "sectionNumber": r"अनुभाग[: ]?(\d+)",
    "locality": r"नगर[: ]?([A-Za-zअ-ह ]+)",
}
# Letters of a voter's name as the roll patterns have them, and with vowel signs too.
ROLL_LETTERS, ROLL_LETTERS_EXTENDED = "अ-ह", "ऀ-ॿ"
GENDERS = ("पु", "म", "स्त्री", "पुरुष", "फ")
MALE = ("पु", "पुरुष")


def roll_patterns(extended: bool = False) -> tuple[str, str]:
    """(strict, fallback) patterns of a voter; with ``extended`` names may hold vowel signs."""
    letters = ROLL_LETTERS_EXTENDED if extended else ROLL_LETTERS
    name, gender = rf"([{letters}A-Za-z ]{{2,}})", f"({'|'.join(GENDERS)})"
    strict = rf"(\d{{1,4}})\s+([A-Za-z{letters}0-9]{{1,8}})?\s*{name}\s+{name}\s+{gender}\s+(\d{{1,3}})"
    return strict, rf"(\d{{1,4}})\s+{name}\s+{gender}\s+(\d{{1,3}})"
