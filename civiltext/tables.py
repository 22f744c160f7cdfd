"""Word lists, rewrite tables and rules.

Everything in this module is data. The values have to stay as they are for
results to be right, so they are written out plainly and in their own order.
Order matters: where a term is listed under two categories the later listing
wins, and phrase hits are reported in listing order.
"""

from __future__ import annotations

# Toxicity categories and their terms.
LEXICON = {
    "insult": [
        "stupid", "idiot", "moron", "dumb", "fool", "loser", "worthless", "pathetic",
        "useless", "brainless", "imbecile", "dimwit", "buffoon", "clown", "ignorant",
        "incompetent", "failure", "retard", "dumbass", "jackass", "asshole", "jerk",
        "bastard", "bitch", "idiot", "scumbag", "lowlife", "piece of shit", "pos",
    ],
    "threat": [
        "kill", "hurt", "destroy", "attack", "harm", "murder", "threaten", "punish",
        "eliminate", "end you", "find you", "come for you", "beat you", "smash you",
        "crush you", "finish you",
    ],
    "hate": [
        "hate", "despise", "detest", "loathe", "abhor", "disgusting", "repulsive", "vile",
        "horrible", "terrible", "awful", "nasty",
    ],
    "obscene": [
        "fuck", "fucking", "fucked", "fucker", "fuck off", "wtf", "shit", "bullshit",
        "shitty", "crap", "ass", "arse", "damn", "hell", "cunt", "dick", "cock", "pussy",
        "piss", "pissed", "bitch", "whore", "slut", "bastard",
    ],
    "aggressive": [
        "shut up", "go away", "get lost", "leave me alone", "stay away", "go to hell",
        "drop dead", "get out", "back off", "piss off", "screw you", "screw off",
        "kiss my ass", "up yours",
    ],
}

# Words that strengthen the word after them.
INTENSIFIERS = ["very", "extremely", "so", "completely", "totally", "utterly", "absolutely"]

# Words that negate one of the three words after them.
NEGATORS = ["not", "never", "no", "neither", "nor"]

# What a hit adds to (or takes off) the intensity of a text.
INTENSIFIER_BOOST = 0.1
THREAT_BOOST = 0.2
NEGATION_DISCOUNT = 0.15

# Neutral wording for toxic terms, in listing order.
REPLACEMENTS = {
    "stupid": "mistaken", "idiot": "person", "moron": "individual", "dumb": "uninformed",
    "fool": "person", "loser": "individual", "worthless": "struggling",
    "pathetic": "disappointing", "useless": "ineffective", "brainless": "uninformed",
    "imbecile": "person", "dimwit": "individual", "buffoon": "person",
    "ignorant": "uninformed", "incompetent": "inexperienced", "failure": "setback",
    "clown": "person", "kill": "stop", "hurt": "upset", "destroy": "change",
    "attack": "address", "harm": "affect", "murder": "confront", "eliminate": "remove",
    "hate": "strongly disagree with", "despise": "strongly dislike", "detest": "dislike",
    "loathe": "dislike", "abhor": "oppose", "disgusting": "concerning",
    "repulsive": "unpleasant", "vile": "problematic", "horrible": "unpleasant",
    "terrible": "poor", "awful": "unfortunate", "nasty": "unpleasant", "fuck": "mess",
    "fucking": "really", "fucked": "ruined", "shit": "stuff", "bullshit": "nonsense",
    "ass": "person", "asshole": "individual", "bitch": "person", "bastard": "person",
    "damn": "very", "crap": "nonsense", "piss off": "go away", "screw you": "I disagree",
    "shut up": "please stop", "go away": "please leave", "get lost": "please go",
}

# If the lower-cased text contains the key, the value replaces the whole text.
SENTENCE_REWRITES = {
    "shut up": "Please consider listening to others.",
    "you're worthless": "You have potential that needs development.",
    "i hate you": "I strongly disagree with your actions.",
    "you're an idiot": "I think there may be a misunderstanding here.",
    "go away": "Please give me some space.",
    "you're stupid": "I think we see this differently.",
    "you're a loser": "Everyone faces challenges at different times.",
    "i will hurt you": "I'm feeling very frustrated right now.",
}

# Phrase rules, applied in order. The pattern text is also what the change
# log shows and what the score counts, so it is kept in the notation users of those see.
CAPITALIZE = "(processed)"
PHRASE_RULES = [
    (r"\byou\s+are\s+(so\s+|very\s+|extremely\s+)?(\w+)", r"your behavior seems \2"),
    (r"\bi\s+hate\s+(you|everyone|all)", r"I strongly disagree with \1"),
    (r"\bgo\s+(away|to hell|f\w+\s+yourself)", r"please excuse yourself"),
    (r"\b(so|very|extremely|completely|utterly|absolutely)\s+(\w+)", r"\2"),
    (r"\bi('ll|will|gonna|am going to)\s+(kill|hurt|destroy|attack|harm)\s+",
     r"I would like to change "),
    (r"!{2,}", "."),
    (r"\b([A-Z]{2,})\b", CAPITALIZE),
]

# Opening and closing tag around a highlighted word.
MARK_OPEN = ('<mark class="toxic-word" style="background-color:#ffcccc;'
             'border-radius:3px;padding:1px 3px;">')
MARK_CLOSE = "</mark>"

# Label columns of a training corpus, in reporting order.
LABELS = ["toxic", "severe_toxic", "obscene", "threat", "insult", "identity_hate"]

# The public English stopword list of the NLTK corpora (179 entries).
STOPWORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours "
    "yourself yourselves he him his himself she she's her hers herself it it's its itself "
    "they them their theirs themselves what which who whom this that that'll these those "
    "am is are was were be been being have has had having do does did doing a an the and "
    "but if or because as until while of at by for with about against between into through "
    "during before after above below to from up down in out on off over under again further "
    "then once here there when where why how all any both each few more most other some such "
    "no nor not only own same so than too very s t can will just don don't should should've "
    "now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn "
    "hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn "
    "needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn "
    "wouldn't"
).split()

# Stopwords that carry meaning here and are kept.
KEPT_STOPWORDS = ["not", "no", "nor", "very", "too", "more", "most"]

# Words the tokenizer splits in two (first part, second part).
CONTRACTIONS = [("can", "not"), ("gon", "na"), ("got", "ta"), ("wan", "na"),
                ("gim", "me"), ("lem", "me")]

# The 32 ASCII punctuation characters.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Sentence templates and slot words of the demonstration corpus.
DEMO_TOXIC = [
    "You are a complete {insult1} and I {hate} you!",
    "What a {insult1} {insult2} you are!",
    "I {hate} people like you, you're {adj1}.",
    "You {insult1}! Just {command}!",
    "This is {adj1} and {adj2} work!",
    "You're so {adj1}, it's {adj2}.",
]
DEMO_CLEAN = [
    "Have a wonderful day!",
    "Thank you for your help with this.",
    "I strongly disagree with your approach.",
    "Could you please explain your reasoning?",
    "I think there might be a better way.",
    "Great work on the project!",
    "I'm not sure I understand your point.",
    "Let's discuss this further.",
]
DEMO_INSULTS = ["idiot", "moron", "fool", "loser", "clown"]
DEMO_HATE = ["hate", "despise", "loathe"]
DEMO_ADJECTIVES = ["stupid", "pathetic", "worthless", "useless", "horrible"]
DEMO_COMMANDS = ["go away", "shut up", "leave", "stop"]
DEMO_THREATS = ["destroy", "kill", "hurt"]
