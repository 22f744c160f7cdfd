"""Golden inputs and results; hits are written word/category/position with +i and +n flags."""

# text, tokens, hits, intensity, combined rewrite, word_replacement rewrite
TEXTS = [
    ('What a dumb clown, I hate you!', 7,
     'dumb/insult/2 clown/insult/3 hate/hate/5', 0.429,
     'I strongly disagree with your actions.',
     'I strongly disagree with your actions.'),
    ("They will destroy our garden if it doesn't rain!", 9,
     'destroy/threat/2', 0.311,
     "They Will Change Our Garden If It Doesn't Rain!",
     "They will change our garden if it doesn't rain!"),
    ('Your plan is utterly worthless and a pathetic mess!', 9,
     'worthless/insult/4+i pathetic/insult/7', 0.322,
     'Your Plan Is Struggling And a Disappointing Mess!',
     'Your plan is utterly struggling and a disappointing mess!'),
    ('Back off now, or just shut up, old jerk!', 9,
     'shut up/aggressive/-1 back off/aggressive/-1 jerk/insult/8', 0.333,
     'Please consider listening to others.',
     'Please consider listening to others.'),
    ("Cats detest water, it's so horrible!", 6,
     'detest/hate/1 horrible/hate/5+i', 0.433,
     "Cats Dislike Water, It's Unpleasant!",
     "Cats dislike water, it's so unpleasant!"),
    ('The library opens at nine. Bring your notes.', 8,
     '', 0.0,
     'The Library Opens At Nine. Bring Your Notes.',
     'The library opens at nine. Bring your notes.'),
    ('Some useless failure, who would pay for that?!', 8,
     'useless/insult/1 failure/insult/2', 0.25,
     'Some Ineffective Setback, Who Would Pay For That?!',
     'Some ineffective setback, who would pay for that?!'),
    ('You are so ignorant, simply a loser, totally useless!', 9,
     'ignorant/insult/3+i loser/insult/6 useless/insult/8+i', 0.533,
     'Your Behavior Seems Uninformed, Simply a Individual, Totally Ineffective!',
     'You are so uninformed, simply a individual, totally ineffective!'),
    ('Go away, or I will hurt you, said the villain!', 10,
     'go away/aggressive/-1 hurt/threat/5', 0.4,
     'Please give me some space.',
     'Please give me some space.'),
    ('Why the hell did that bastard break my damn bike?', 10,
     'hell/obscene/2 bastard/obscene/5 damn/obscene/8', 0.3,
     'Why The Hell Did That Person Break My Bike?',
     'Why the hell did that person break my very bike?'),
    ("Critics loathe this film, it's vile and so awful.", 9,
     'loathe/hate/1 vile/hate/5 awful/hate/8+i', 0.433,
     "Critics Dislike This Film, It's Problematic And Unfortunate.",
     "Critics dislike this film, it's problematic and so unfortunate."),
    ("Piss off, you damn clown!!!", 5,
     "piss off/aggressive/-1 piss/obscene/0 damn/obscene/3 clown/insult/4", 0.8,
     "Please Leave, You Person.", "Please leave, you very person!!!"),
    ("This is so very awful", 5, "awful/hate/4+i", 0.3,
     "This Is Very Unfortunate.", "This is so very unfortunate."),
    ("go to hell", 3, "go to hell/aggressive/-1 hell/obscene/2", 0.667,
     "Please Excuse Yourself.", "Go to hell."),
    ("get lost away", 3, "get lost/aggressive/-1", 0.333,
     "Please Please Leave.", "Please please leave."),
    ("größe of the cargo away ass", 6, "go away/aggressive/-1 ass/obscene/5", 0.333,
     "Please give me some space.", "Please give me some space."),
    ("That is NOT terrible", 4, "terrible/hate/3+n", 0.1,
     "That Is Not Poor.", "That is NOT poor."),
    ("I'm never very stupid.", 4, "stupid/insult/3+i+n", 0.2,
     "I'm Never Mistaken.", "I'm never very mistaken."),
    ("Send your friend your best", 5, "end you/threat/-1", 0.4,
     "Send Your Friend Your Best.", "Send your friend your best."),
    ("i hate people", 3, "hate/hate/1", 0.333,
     "I Strongly Disagree With People.", "I strongly disagree with people."),
    ("x", 1, "", 0.0, "X.", "X."),
]

# text, cleaned for the model, cleaned lightly
CLEANED = [
    ("THIS Is Loud!! See www.example.org", "this is loud see", "this is loud see"),
    ("Enjoy your trip, friends! 🚲", "enjoy your trip friends", "enjoy your trip friends 🚲"),
    ("<b>Hello</b>!! World123", "hello world", "hello world123"),
    ('<a href="http://x.com">link</a> z', "a href z", "a href z"),
    ("größe cannot café", "gr e can not caf", "größe cannot café"),
    ("a<i\nb>c", "a i b c", "ai\nbc"),
    ("\t   ", "", ""),
    (None, "", ""),
]
