"""Stopword lists.

HANDLE_STOPWORDS is the English list the reference filters mention
handles with (a third-party corpus, 179 words). Its values must match for
the same results, so they are stated here as fixed text.

MODEL_STOPWORDS is the StopWordsRemover default used for model tokens
(I02), also as fixed text: nothing is read from the Spark install.
"""

from __future__ import annotations

# English stopwords used to filter handles (179 words).
HANDLE_STOPWORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd "
    "your yours yourself yourselves he him his himself she she's her hers "
    "herself it it's its itself they them their theirs themselves what "
    "which who whom this that that'll these those am is are was were be "
    "been being have has had having do does did doing a an the and but if "
    "or because as until while of at by for with about against between "
    "into through during before after above below to from up down in out "
    "on off over under again further then once here there when where why "
    "how all any both each few more most other some such no nor not only "
    "own same so than too very s t can will just don don't should "
    "should've now d ll m o re ve y ain aren aren't couldn couldn't didn "
    "didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't "
    "ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn "
    "shouldn't wasn wasn't weren weren't won won't wouldn wouldn't"
).split()

# The default English list of Spark ML's StopWordsRemover
# (181 words), which the model tokens (I02) are filtered with.
MODEL_STOPWORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves "
    "he him his himself she her hers herself it its itself they them their "
    "theirs themselves what which who whom this that these those am is are "
    "was were be been being have has had having do does did doing a an the "
    "and but if or because as until while of at by for with about against "
    "between into through during before after above below to from up down in "
    "out on off over under again further then once here there when where why "
    "how all any both each few more most other some such no nor not only own "
    "same so than too very s t can will just don should now i'll you'll he'll "
    "she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's "
    "she's it's we're they're i've we've you've they've isn't aren't wasn't "
    "weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't "
    "shouldn't mustn't can't couldn't cannot could here's how's let's ought "
    "that's there's what's when's where's who's why's would"
).split()


def spark_english_stopwords() -> tuple[str, ...]:
    return tuple(MODEL_STOPWORDS)
