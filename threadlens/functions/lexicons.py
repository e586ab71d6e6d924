"""Word lists and constants.

FIXED VALUES — these must equal the values of the original stance pipeline
for the features to mean the same thing. They are listed plainly, in their
natural order. Long lexicons (the swear-word list has several hundred
entries) are NOT kept here: they are a parameter, read with
``threadlens.sources.lexicon.read_lexicon(path)`` from the user's file.
"""

# Stance classes; the class id is the position in this list.
STANCE_CLASSES = ["support", "comment", "deny", "query"]

# Words counted (distinct) by the negation feature.
NEGATION_WORDS = [
    "not", "no", "nobody", "nothing", "none", "never", "neither", "nor",
    "nowhere", "hardly", "scarcely", "barely", "don", "isn", "wasn",
    "shouldn", "wouldn", "couldn", "doesn",
]

# Words that flag a post / thread as talking about a rumour.
RUMOUR_WORDS = ["rumour", "gossip"]

# Substrings behind the url / picture flags.
URL_MARKERS = ["urlurlurl", "http"]
PIC_MARKERS = ["picpicpic", "pic.twitter.com", "instagr.am"]

# Entity classes of the entity vector; the id is the position, 0 = unknown.
ENTITY_CLASSES = [
    "UNK", "PERSON", "NORP", "FAC", "ORG", "GPE", "LOC", "PRODUCT", "EVENT",
    "WORK_OF_ART", "LAW", "LANGUAGE", "DATE", "TIME", "PERCENT", "MONEY",
    "QUANTITY", "ORDINAL", "CARDINAL",
]

# Whole-word splits the word tokenizer applies after punctuation is gone
# (public behaviour of the Penn-Treebank style tokenizer).
CONTRACTION_SPLITS = [
    ("cannot", ["can", "not"]),
    ("gimme", ["gim", "me"]),
    ("gonna", ["gon", "na"]),
    ("gotta", ["got", "ta"]),
    ("lemme", ["lem", "me"]),
    ("wanna", ["wan", "na"]),
]

# Separator between source, previous and target text in the triple text.
TRIPLE_SEPARATOR = "\n-----------\n"

# Sequence encoding: reserved ids of the corpus vocabulary.
PAD_ID, UNK_ID, CLS_ID, SEP_ID = 0, 1, 2, 3
FIRST_TOKEN_ID = 4

# Defaults of the training configuration.
DEFAULT_MAX_LENGTH = 200
DEFAULT_BATCH_SIZE = 2
DEFAULT_TRUE_BATCH_SIZE = 32
DEFAULT_PATIENCE = 4
DEFAULT_VOCAB_SIZE = 30522

# A short swear-word lexicon for the fixtures; the operators take the lexicon as
# an argument and have no default.
FIXTURE_SWEAR_LEXICON = ["crap", "hell", "damn", "bastard", "bitch", "shit"]

# Default gazetteer of the rule-based entity tagger (ours: statistical NER is
# replaced by a word list plus a numeral rule). Entity name -> lower-case words.
DEFAULT_GAZETTEER = {
    "DATE": ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday",
             "sunday", "january", "february", "march", "april", "may", "june",
             "july", "august", "september", "october", "november", "december",
             "today", "yesterday", "tomorrow"],
    "TIME": ["am", "pm", "noon", "midnight", "tonight"],
    "ORDINAL": ["first", "second", "third", "fourth", "fifth", "sixth",
                "seventh", "eighth", "ninth", "tenth"],
    "LANGUAGE": ["english", "french", "german", "spanish", "italian"],
    "CARDINAL": ["one", "two", "three", "four", "five", "six", "seven", "eight",
                 "nine", "ten", "hundred", "thousand", "million"],
}
