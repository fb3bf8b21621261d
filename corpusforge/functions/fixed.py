"""Values that must be exactly these for right results."""

# Section headings that are skipped (a full match, in any case).
SKIPPED_HEADINGS = (
    "se også", "eksterne henvisninger", "kilder", "referencer", "litteratur", "fodnoter", "noter", "galleri", "spor",
    "medvirkende", "diskografi", "filmografi", "bibliografi", "priser", "links", "weblinks", "external links", "see also",
    "references", "hædersbevisninger", "gengivelser", "vælgertilslutning", "mandater", "valg", "valgresultater", "resultater",
    "statistik", "rekorder", "meritter", "karrierestatistik", "kampresultater", "placeringer", "hold", "besætning",
    "udgivelser", "singler", "album", "værker", "roller", "episoder", "episodeliste", "sæson", "sæsoner", "æresbevisninger",
    "ordner og dekorationer", "udmærkelser", "personlige rekorder",
)

# Scripts that do not occur in Danish text, as ranges of code points.
FOREIGN_SCRIPTS = (
    (0x0400, 0x04FF), (0x0600, 0x06FF), (0x0900, 0x097F), (0x0E00, 0x0E7F), (0x3000, 0x303F), (0x3040, 0x309F),
    (0x30A0, 0x30FF), (0x4E00, 0x9FFF), (0xAC00, 0xD7AF), (0x20000, 0x2A6DF),
)

# Words that may hold a doubled syllable.
DOUBLED_ALLOWED = (
    "alle", "allerede", "alligevel", "behandlingen", "eventuelt", "eventually", "hovedsageligt", "indeholder", "lille",
    "mange", "muligvis", "nødvendigvis", "parallelle", "parallel", "visse",
)

# Signs taken off the ends of a word, and the longer set used for clusters and old spellings.
WORD_SIGNS = ".,;:!?()[]{}\"'»«–—-"
WORD_SIGNS_LONG = WORD_SIGNS + "/\\"
VOWELS = "aeiouyæøå"

# Starts of list lines and of speech lines.
LIST_STARTS = ("* ", "- ", "| ", "1.", "2.", "3.")
SPEECH_STARTS = ("– ", "— ", "» ", "\"", "“")
# Pairs of quotation marks; inside stand two characters or more other than the closing mark.
QUOTE_PAIRS = (("\"", "\""), ("»", "«"), ("“", "”"), ("„", "“"))

# Place names with aa, and words of the old spelling.
AA_PLACES = ("aalborg", "aarhus", "aabenraa", "aarup", "aakirkeby", "aalestrup", "aabybro", "aars", "aasiaat")
OLD_WORDS = (
    "thi", "skulde", "saadan", "saadanne", "eder", "giøre", "giorde", "hielpe", "hielp", "saae", "staaer", "haabe", "gaaer",
    "gaae", "maae", "maatte", "altsaa", "saaledes", "ligeledes",
)

# Words that mark Danish.
DANISH_MARKERS = (
    "og", "er", "det", "en", "at", "på", "for", "med", "har", "den", "til", "af", "kan", "de", "som", "ikke", "vil", "der",
    "jeg", "han", "hun", "vi", "efter", "også", "blev", "fra", "deres", "eller", "denne", "var", "mere",
)

# Starts of a refused instruction (case and apostrophe as written).
REFUSAL_STARTS = ("I'm sorry", "I apologize", "I cannot", "I can't", "Jeg beklager", "Undskyld", "Jeg kan ikke", "Det er ikke muligt")

# Source type of a named subset, and the subsets of a run over everything.
SUBSET_TYPES = {
    "wikipedia": "knowledge", "danske-taler": "speech", "ft": "speech", "nordjyllandnews": "news", "dkmedier": "news",
    "miljoeportalen": "government", "ai-aktindsigt": "government",
}
RUN_SUBSETS = ("wikipedia", "danske-taler", "ft", "nordjyllandnews", "miljoeportalen", "ai-aktindsigt")
DEFAULT_TYPE = "knowledge"
FORMATS = ("A", "B", "C")
