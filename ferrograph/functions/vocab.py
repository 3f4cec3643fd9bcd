"""Words, tables and patterns the results depend on."""

# Primary classes and what they are also called.
PRIMARY_CLASSES = ["Light Tanks", "Medium Tanks", "Heavy Tanks", "Tank Destroyers", "SPGs"]
CLASS_ALIASES = {
    "light tank": "Light Tanks", "light tanks": "Light Tanks", "light": "Light Tanks", "lt": "Light Tanks", "lighttank": "Light Tanks",
    "medium tank": "Medium Tanks", "medium tanks": "Medium Tanks", "medium": "Medium Tanks", "mt": "Medium Tanks", "mediumtank": "Medium Tanks",
    "heavy tank": "Heavy Tanks", "heavy tanks": "Heavy Tanks", "heavy": "Heavy Tanks", "ht": "Heavy Tanks", "heavytank": "Heavy Tanks",
    "tank destroyer": "Tank Destroyers", "tank destroyers": "Tank Destroyers", "td": "Tank Destroyers", "ttd": "Tank Destroyers", "at-spg": "Tank Destroyers", "atspg": "Tank Destroyers",
    "spg": "SPGs", "spgs": "SPGs", "artillery": "SPGs", "self-propelled gun": "SPGs", "self-propelled guns": "SPGs",
}
# Subclasses, and categories that only organize others.
SUBCLASS_ALIASES = {"autoloader": "Autoloaders", "autoloaders": "Autoloaders"}
ORGANIZATIONAL = ["tanks", "tanks by nation", "tanks by tier", "tanks by type", "premium tanks", "removed tanks", "tanktree", "unintroduced tanks", "upcoming tanks"]
# Nations and what they are also called.
NATIONS = ["USSR", "Germany", "USA", "France", "UK", "China", "Japan", "Czechoslovakia", "Sweden", "Poland", "Italy"]
NATION_ALIASES = {
    "ussr": "USSR", "u.s.s.r": "USSR", "u.s.s.r.": "USSR", "soviet": "USSR", "soviet union": "USSR", "russia": "USSR", "russian": "USSR",
    "germany": "Germany", "german": "Germany",
    "usa": "USA", "u.s.a": "USA", "u.s.a.": "USA", "us": "USA", "u.s.": "USA", "united states": "USA", "united states of america": "USA", "america": "USA", "american": "USA",
    "france": "France", "french": "France",
    "uk": "UK", "u.k": "UK", "u.k.": "UK", "united kingdom": "UK", "great britain": "UK", "britain": "UK", "british": "UK",
    "china": "China", "chinese": "China", "prc": "China", "p.r.c.": "China",
    "japan": "Japan", "japanese": "Japan",
    "czechoslovakia": "Czechoslovakia", "czechoslovak": "Czechoslovakia", "czech": "Czechoslovakia", "czech republic": "Czechoslovakia",
    "sweden": "Sweden", "swedish": "Sweden",
    "poland": "Poland", "polish": "Poland",
    "italy": "Italy", "italian": "Italy",
}
# Tiers in Roman numerals.
ROMAN_TIERS = {"i": 1, "ii": 2, "iii": 3, "iv": 4, "v": 5, "vi": 6, "vii": 7, "viii": 8, "ix": 9, "x": 10}
# Dashes that count as a hyphen.
HYPHENS = "֊־᐀᠆‐‑‒–—―−⸗⸚⸺⸻⹀〜〰゠︱︲﹘﹣－"
# Concepts and their other names; words dropped from keywords.
CONCEPT_ALIASES = {
    "side scrape": "sidescraping", "side-scrape": "sidescraping", "side scraping": "sidescraping", "sidescrape": "sidescraping", "sidescraping": "sidescraping",
    "hull down": "hull-down", "hull-down": "hull-down", "hull down position": "hull-down", "hull-down position": "hull-down",
    "view range": "view range", "view-range": "view range", "vision range": "view range",
    "long range sniping": "sniping", "long-range sniping": "sniping", "snipe": "sniping", "sniping": "sniping",
}
# Terms that are no keywords by themselves.
GENERIC_TERMS = ["battle", "game", "guide", "player", "tank", "thing", "vehicle", "world"]
STOP_WORDS = "a an and at be by for from in into is it of on or that the their this to with your".split()
# Nouns of tactics.
TACTICAL_NOUNS = """
accuracy aim ambush armor camouflage concealment cover damage equipment flank gun hull mobility position reload repair
retreat scout shell shoot sidescraping snipe sniping spot survival target terrain track vision
""".split()
# What makes a statement tactical (word beginnings), an instruction, or neither.
TACTICAL = (
    "accuracy|aim|ambush|armor|battle|camouflage|conceal|consumable|cover|crew|damage|defen[cs]|equipment|flank|gun|hull|map|mobility|"
    "position|reload|repair|retreat|scout|shell|shoot|side.?scrap|snip|spot|surviv|tactic|target|terrain|track|view range|vision|weak(?:ness| spot)"
)
IMPERATIVE = "avoid|equip|keep|move|position|protect|retreat|stay|support|take|target|use|watch"
NON_TACTICAL = "account|economy|event|gold|log[ -]?in|purchase|region selector|store"
# Ranks of sources, the least first.
SOURCE_RANKS = {"wiki": 0, "wiki_vehicle": 0, "vehicle_wiki": 0, "class_guide": 1, "guide_class": 1, "universal_guide": 2, "guide_universal": 2, "guide": 2}
# Headings, classes, concepts and access pages of guides.
RELEVANT_HEADING = (
    "vehicle types?|pre-battle setup|battlefield|roles?|surviv(?:al|e)|aim(?:ing)?|equipment|consumables?|crew|tactics?|tank coach|view range|vision|"
    "light tanks?|medium tanks?|heavy tanks?|tank destroyers?|spgs?|artillery|self-propelled guns?"
)
UNIVERSAL_HEADING = "pre-battle setup|battlefield|surviv(?:al|e)|aim(?:ing)?|equipment|consumables?|crew(?: capabilities)?|tactics?|tank coach"
GUIDE_TACTICAL = (
    "aim|armor|battle|camouflage|conceal|cover|crew|damage|equipment|flank|gun|hull|map|mobility|position|reload|repair|retreat|scout|shell|shoot|"
    "side.?scrap|spot|surviv|tactic|target|terrain|track|view range|vision"
)
GUIDE_CONCEPTS = {"equipment": "equipment", "view range": "(?:view|vision)[ -]range", "hull-down": "hull[ -]down", "sidescraping": r"side[ -]scrap\w*"}
HEADING_CLASSES = {
    "Tank Destroyers": "tank destroyers?", "SPGs": "spgs?|artillery|self-propelled guns?", "Light Tanks": "light tanks?",
    "Medium Tanks": "medium tanks?", "Heavy Tanks": "heavy tanks?",
}
ACCESS_DOCUMENT = (
    "access denied|account login|log in to continue|sign in to continue|verify (?:that )?you are human|captcha|security challenge|"
    "request blocked|error\\s+(?:403|404|500|502|503)|page not found"
)
# Where a guide's content stands, what stands around it, and parameters of addresses that only track.
CONTENT_ROOTS = ["main", "article", ".article-content", ".article_content", ".content-guide", ".guide-content"]
BOILERPLATE_TAGS = ["nav", "footer", "header", "script", "style", "form", "dialog"]
BOILERPLATE_NAMES = ["cookie", "share", "sharing", "breadcrumb", "recommend", "related"]
TRACKING_KEYS = ["fbclid", "gclid", "mc_cid", "mc_eid", "ref", "source", "yclid"]
# Infoboxes of wiki pages.
INFOBOXES = ["vehicle", "tankdata", "tank data"]
INFOBOX_FIELDS = {
    "identifier": ["id", "internal name", "tank id", "tank"],
    "display_name": ["display name", "title", "name"],
    "primary_class": ["class", "type"],
    "nation": ["nation", "country"],
    "tier": ["tier", "level"],
}
# Fields of infoboxes that hold sections, and the category of unfinished pages.
INFOBOX_SECTIONS = {"Performance": ["inthegame performance", "in the game performance"], "Tactics": ["inthegame tactics", "in the game tactics"]}
MAINTENANCE = "tank articles requiring maintenance"
# Labels of entities that are no concepts.
EXCLUDED_ENTITIES = ["CARDINAL", "DATE", "MONEY", "ORDINAL", "PERCENT", "PERSON", "QUANTITY", "TIME"]
