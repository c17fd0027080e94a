"""Default word lists. All of them are parameters of the functions using them."""

# Polarity lexicon of this library: word -> polarity in [-1, 1]. Values are
# multiples of 1/4, so sums are exact in any order.
LEXICON: dict[str, float] = {
    "amazing": 0.75,
    "awesome": 1.0,
    "beneficial": 0.5,
    "best": 1.0,
    "better": 0.5,
    "calm": 0.25,
    "comfortable": 0.5,
    "easy": 0.5,
    "effective": 0.5,
    "excellent": 1.0,
    "fantastic": 0.75,
    "fine": 0.5,
    "glad": 0.5,
    "good": 0.75,
    "grateful": 0.75,
    "great": 0.75,
    "happy": 0.75,
    "helped": 0.5,
    "helpful": 0.5,
    "helps": 0.5,
    "improved": 0.5,
    "love": 0.5,
    "loved": 0.75,
    "miracle": 0.75,
    "nice": 0.5,
    "perfect": 1.0,
    "pleasant": 0.75,
    "recommend": 0.5,
    "relief": 0.5,
    "safe": 0.5,
    "satisfied": 0.5,
    "thankful": 0.75,
    "wonderful": 1.0,
    "worked": 0.25,
    "works": 0.25,
    "angry": -0.5,
    "annoying": -0.75,
    "awful": -1.0,
    "bad": -0.75,
    "dangerous": -0.5,
    "depressed": -0.5,
    "difficult": -0.5,
    "disappointed": -0.75,
    "disgusting": -1.0,
    "dizzy": -0.25,
    "fail": -0.5,
    "failed": -0.5,
    "hate": -0.75,
    "hated": -1.0,
    "horrible": -1.0,
    "idiot": -0.75,
    "illegal": -0.5,
    "loser": -0.5,
    "miserable": -1.0,
    "moron": -0.75,
    "nausea": -0.25,
    "nightmare": -0.75,
    "pain": -0.25,
    "painful": -0.75,
    "pathetic": -1.0,
    "poor": -0.5,
    "sad": -0.5,
    "severe": -0.25,
    "sick": -0.75,
    "stupid": -0.75,
    "terrible": -1.0,
    "trash": -0.5,
    "ugly": -0.75,
    "unbearable": -0.75,
    "upset": -0.25,
    "useless": -0.5,
    "worse": -0.5,
    "worst": -1.0,
    "worthless": -0.75,
    "wrong": -0.5,
}

# A lexicon word right after one of these, or after a word ending in "n't",
# counts with the factor below.
NEGATORS: tuple[str, ...] = ("no", "not", "never")
NEGATION_FACTOR = -0.5

# The common English stop word list that word clouds leave out.
STOPWORDS: tuple[str, ...] = tuple(
    """
    a about above after again against all also am an and any are aren't as at
    be because been before being below between both but by
    can can't cannot com could couldn't
    did didn't do does doesn't doing don't down during
    each else ever few for from further get
    had hadn't has hasn't have haven't having he he'd he'll he's hence her here
    here's hers herself him himself his how how's however http
    i i'd i'll i'm i've if in into is isn't it it's its itself just k
    let's like me more most mustn't my myself no nor not
    of off on once only or other otherwise ought our ours ourselves out over own
    r same shall shan't she she'd she'll she's should shouldn't since so some such
    than that that's the their theirs them themselves then there there's therefore
    these they they'd they'll they're they've this those through to too
    under until up very was wasn't we we'd we'll we're we've were weren't
    what what's when when's where where's which while who who's whom why why's
    with won't would wouldn't www
    you you'd you'll you're you've your yours yourself yourselves
    """.split()
)
