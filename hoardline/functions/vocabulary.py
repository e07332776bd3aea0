"""The word lists and lookup tables that results must agree with."""

from __future__ import annotations

# Objects that are not coins.
NON_COIN_WORDS = [
    "token", "medal", "jeton", "replica", "fantasy", "copy", "reproduction", "seal", "weight",
    "exonumia", "banknote", "note ", "paper money",
]

# Words that signal a period, in declaration order.
PERIOD_WORDS = {
    "roman_imperial": [
        "imperial", "augustus", "caesar", "ric", "cohen", "bmcre", "kaiser", "sestertius",
        "antoninianus", "dupondius", "semis", "quadrans", "tiberius", "caligula", "claudius", "nero",
        "galba", "otho", "vitellius", "vespasian", "titus", "domitian", "nerva", "trajan", "hadrian",
        "antoninus", "aurelius", "commodus", "septimius", "severus", "caracalla", "geta", "macrinus",
        "elagabalus", "gordian", "philip", "decius", "gallus", "valerian", "gallienus", "aurelian",
        "probus", "diocletian", "maximian", "constantius", "constantine", "licinius",
    ],
    "roman_provincial": [
        "provincial", "rpc", "cappadocia", "syria", "alexandria", "arabia", "bostra",
        "billon tetradrachm",
    ],
    "roman_republican": [
        "republic", "republican", "republik", "crawford", "sydenham", "aes grave", "quadrigatus",
        "victoriatus", "anonyme", "prägungen",
    ],
    "greek": [
        "greek", "magna graecia", "sicily", "attica", "athens", "ptolemaic", "seleucid", "sng", "hgc",
        "thrace", "moesia", "pisidia", "bithynia", "pontus", "paphlagonia", "phrygia", "lycia",
        "pamphylia", "cilicia", "galatia", "ionia", "etruria", "lucania", "argolis", "epirus",
        "thessaly", "elymais", "kyrenaika", "cyrenaica",
    ],
    "byzantine": [
        "byzantine", "doc", "sb", "trachy", "pentanummium", "decanummium", "hyperpyron", "histamenon",
        "tetarteron", "nomisma",
    ],
    "islamic": [
        "islamic", "dirham", "dinar", "fals", "umayyad", "abbasid", "artuqid", "seljuq", "ottoman",
    ],
    "medieval": [
        "medieval", "crusader", "anglo-saxon", "anglo saxon", "grosso", "denier", "penny", "sceat",
        "sceatta", "styca", "bracteate", "serbia", "genoa", "genova", "venice", "bulgaria", "hungary",
        "france", "louis", "austria", "hanover", "royal",
    ],
    "celtic": ["celtic", "gaul", "danubian", "stater", "potin"],
    "persian": ["persian", "sasanian", "parthian", "siglos", "daric"],
    "modern": [
        "hanover", "victoria", "victorian", "george iii", "george iv", "william iv", "18th century",
        "19th century", "modern",
    ],
}

# Denomination keyword -> denomination, in declaration order.
DENOMINATIONS = {
    "nomisma": "solidus", "solidus": "solidus", "histamenon": "histamenon",
    "tetarteron": "tetarteron", "hyperpyron": "hyperpyron", "tremissis": "tremissis",
    "follis": "follis", "hexagram": "hexagram", "siliqua": "siliqua",
    "drachm": "drachm", "didrachm": "didrachm", "tridrachm": "tridrachm",
    "tetradrachm": "tetradrachm", "hemidrachm": "hemidrachm", "stater": "stater",
    "distater": "distater", "litra": "litra", "obol": "obol", "diobol": "diobol",
    "triobol": "triobol", "hemiobol": "hemiobol",
    "aureus": "aureus", "quinarius": "quinarius", "denarius": "denarius",
    "antoninianus": "antoninianus", "double sestertius": "double_sestertius",
    "sestertius": "sestertius", "dupondius": "dupondius", "as": "as", "semis": "semis",
    "quadrans": "quadrans", "aes grave": "aes_grave",
    "dirham": "dirham", "dinar": "dinar", "fals": "fals",
    "sceatta": "sceatta", "styca": "styca", "denier": "denier", "penny": "penny",
    "grosso": "grosso", "matapan": "grosso", "crown": "crown",
}

# Material keyword -> material, in declaration order.
MATERIALS = {
    "av": "gold", "gold": "gold", "aureus": "gold", "solidus": "gold", "el": "electrum",
    "electrum": "electrum", "ar": "silver", "silver": "silver", "denarius": "silver",
    "siliqua": "silver", "miliarense": "silver", "ae": "bronze", "bronze": "bronze",
    "copper": "bronze", "brass": "bronze", "orichalcum": "bronze", "bi": "billon",
    "billon": "billon", "potin": "potin",
}

# Periods in which a denomination was struck.
DENOMINATION_PERIODS = {
    "solidus": ["roman_imperial", "byzantine", "medieval", "modern"],
    "histamenon": ["byzantine"],
    "tetarteron": ["byzantine"],
    "hyperpyron": ["byzantine"],
    "tremissis": ["roman_imperial", "byzantine", "medieval"],
    "siliqua": ["roman_imperial", "byzantine"],
    "follis": ["roman_imperial", "byzantine"],
    "aureus": ["roman_imperial", "roman_republican"],
    "denarius": ["roman_imperial", "roman_republican"],
    "quinarius": ["roman_imperial", "roman_republican"],
    "sestertius": ["roman_imperial", "roman_republican"],
    "dupondius": ["roman_imperial"],
    "antoninianus": ["roman_imperial", "roman_provincial"],
    "aes_grave": ["roman_republican"],
    "stater": ["greek", "persian", "celtic"],
    "tetradrachm": ["greek", "roman_provincial", "celtic", "persian"],
    "drachm": ["greek", "persian", "islamic"],
    "hemidrachm": ["greek", "persian"],
    "obol": ["greek"],
    "diobol": ["greek"],
    "triobol": ["greek"],
    "dirham": ["islamic"],
    "dinar": ["islamic", "medieval", "modern"],
    "sceatta": ["medieval"],
    "styca": ["medieval"],
    "denier": ["medieval"],
    "grosso": ["medieval", "byzantine"],
    "crown": ["medieval", "modern"],
}

# Regions that were provinces in imperial times (substring match).
PROVINCIAL_REGIONS = [
    "thrace", "moesia", "bithynia", "pontus", "paphlagonia", "phrygia", "lycia", "pamphylia",
    "cilicia", "galatia", "pisidia", "cappadocia", "syria", "egypt", "alexandria", "arabia", "bostra",
    "antioch", "seleucia", "ionia",
]

# Greek city states (substring match).
GREEK_CITIES = [
    "athens", "aegina", "corinth", "thebes", "argos", "syracuse", "gela", "akragas", "katane",
    "leontini", "tarentum", "metapontum", "croton", "sybaris", "miletos", "ephesos", "samos", "chios",
    "teos", "phokaia", "erythrai", "klazomenai", "rhodes", "knidos", "halikarnassos", "thasos",
    "abdera", "maroneia", "amphipolis", "olynthos",
]

# Celtic tribes (word match).
CELTIC_TRIBES = [
    "aedui", "sequani", "parisii", "nervii", "bituriges", "arverni", "helvetii", "boii", "boier",
    "volcae", "remi", "iceni", "trinovantes", "catuvellauni",
]

# Signals of regions outside the taxonomy (substring match).
EXOTIC_SIGNALS = ["kabul", "shahi", "kushano", "hephthalite", "local issues"]

# Period inferred from the denomination alone: period -> (confidence, denominations).
DENOMINATION_INFERENCE = {
    "greek": (0.80, [
        "obol", "diobol", "triobol", "hemiobol", "drachm", "hemidrachm", "tetradrachm", "stater",
        "distater",
    ]),
    "byzantine": (0.85, ["solidus", "histamenon", "tetarteron", "hyperpyron"]),
    "medieval": (0.80, ["denier", "penny", "sceatta", "styca", "grosso"]),
}

# Notes and warnings attached to a parsed label.
NOTE_NON_COIN = "Excluded non-coin object"
NOTE_PERSIAN = "Parthian normalized to Persian"
NOTE_PROVINCIAL = "Provincial Logic: imperial-era region (emperor not required)"
NOTE_MODERN = "Modern override: Hanover+ / 18th–19th c. signal"
NOTE_CELTIC = "Celtic tribal authority detected"
NOTE_CITY = "Greek civic polis detected"
NOTE_EXOTIC = "Exotic region - requires manual review"
NOTE_INFERRED = {
    "greek": "Inferred Greek from denomination",
    "byzantine": "Inferred Byzantine from denomination",
    "medieval": "Inferred Medieval from denomination",
}
WARN_MODERN = "Modern signal mixed with ancient signals"
WARN_MULTIPLE = "Multiple period signals"
WARN_NO_PERIOD = "No period detected - requires manual classification"

# Keyword label: first class, in this order, with a keyword inside the text.
KEYWORD_CLASSES = {
    "roman_imperial": ["imperial", "augustus", "denarius", "sestertius", "antoninianus"],
    "roman_provincial": ["provincial", "cappadocia", "syria", "alexandria", "tetradrachm"],
    "roman_republican": ["republican", "denarius", "anonymous", "crawford"],
    "greek": ["greek", "athens", "tetradrachm", "drachm", "stater", "sicily", "macedon"],
    "byzantine": ["byzantine", "follis", "solidus", "nomisma", "trachy"],
    "islamic": ["islamic", "dirham", "dinar", "fals", "abbasid", "umayyad"],
    "medieval": ["medieval", "penny", "denier", "grosso", "sceat", "styca", "anglo-saxon"],
    "celtic": ["celtic", "stater", "potin", "danubian"],
    "persian": ["persian", "siglos", "daric", "sasanian", "parthian"],
}

# Spellings of denominations in running text.
DENOMINATION_SPELLINGS = {
    "denarius": r"\bdenari(?:us|i)\b",
    "aureus": r"\baureu[sm]\b",
    "sestertius": r"\bsesterti(?:us|i)\b",
    "as": r"\b(?:as|asses)\b",
    "antoninianus": r"\bantoninian(?:us|i)\b",
    "solidus": r"\bsolid(?:us|i)\b",
    "tremissis": r"\btremissis\b",
    "semissis": r"\bsemissis\b",
    "follis": r"\bfoll(?:is|es)\b",
    "nummus": r"\bnumm(?:us|i)\b",
    "tetradrachm": r"\btetradrachm?\b",
    "drachm": r"\bdrachm(?:a|s)?\b",
    "stater": r"\bstaters?\b",
    "obol": r"\bobols?\b",
}

# Group lots and modern pieces, first matching pattern wins.
GROUP_LOT_PATTERNS = [
    r"\blot of\b", r"\bgroup of\b", r"\brun of\b", r"\bcollection of\b", r"\b\d+ coins\b",
    r"\b\d+ pieces\b", r"\bmiscellaneous\b", r"\bvarious\b.*\bcoins\b", r"\bmixed lot\b",
]
MODERN_PATTERNS = [
    r"\b1[89]\d{2}\b", r"\b20[012]\d\b", r"\bvictoria\b", r"\bgeorge [iv]+\b", r"\bwilliam iv\b",
    r"\bqueen elizabeth\b", r"\beuro\b", r"\bdollar\b", r"\bfranc\b.*\b19\d{2}\b",
    r"\bmark\b.*\b19\d{2}\b", r"\bpfennig\b.*\b19\d{2}\b", r"\bcommemorative\b", r"\bproof\b",
    r"\buncirculated\b.*\bmint\b",
]

# Period taxonomy of the export summary.
TAXONOMY_PERIODS = [
    "greek", "roman_republican", "roman_imperial", "roman_provincial", "byzantine", "celtic", "islamic",
]

# Lot page by auction house; {sale}, {lot} and {lot6} (six-digit lot) are filled in.
LOT_URLS = {
    "numisbids": "https://www.numisbids.com/n.php?p=lot&sid={sale}&lot={lot}",
    "leu": "https://leunumismatik.com/en/lot/{sale}/{lot}",
    "gorny": "https://auktionen.gmcoinart.de/Los/{sale}/{lot}.0",
    "nomos": "https://nomosag.com/nomos-{sale}/{lot}",
    "obolos": "https://nomosag.com/obolos-{sale}/{lot}",
    "cng": "https://cngcoins.com/Lot.aspx?LOT_ID={lot}",
    "spink": "https://www.spink.com/lot/{sale}{lot6}",
    "kuenker": "https://www.kuenker.de/en/archiv/stueck/{lot}",
    "kuenker_auex": "https://auex.de/de/product/{sale}-{lot}",
}
