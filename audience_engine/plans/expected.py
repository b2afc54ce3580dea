"""What the check SQL expects of the engine's words and patterns, written out a second time.

The checks don't read the engine's own lists, so that a slip in those shows.
"""

# --- Fixed values: results depend on these exact words and patterns, so they are stated as they are. ---

TOXIC_WORDS = "idiot stupid trash worst hate scam cringe".split()
POSITIVE_WORDS = "great love awesome useful works".split()
NEGATIVE_WORDS = "hate worst useless broken".split()
SIGNAL_PHRASES = (
    "launch,announcement,preorder,drop,collab,ugc,giveaway,challenge,comment below,subscribe,link in bio,waitlist,cpm,cpc,roas,"
    "conversion,retarget,short-form,reel,short,story,carousel,duet,stitch,brand deal,referral,limited time,discount,early access"
).split(",")
DQ_REASONS = "lang_other toxicity_gt_0.30 ed_lt_0.20 no_signal_or_hashtag".split()
RANK_CTA_WORDS = "buy subscribe click signup".split()
PRIOR_CTA_WORDS = "buy cta click signup".split()
AI_WORDS = "ai openai gpt".split()
CAPTION_TEMPLATES = (
    "Key take: {snippet}",
    'People say: "{snippet}" — this made us think about [topic]',
    "Hot take: {snippet} — what do you think?",
    "Short: {snippet}",
)

# --- End of the fixed values. The rest are this library's own. ---

NEGATORS = (
    "not no never none nobody nothing neither nor cannot without can't don't doesn't didn't isn't wasn't won't wouldn't "
    "shouldn't couldn't aren't weren't hasn't haven't hadn't cant dont doesnt didnt isnt wasnt wont"
).split()
URL = r"https?://\S+|www\.\S+"
EMAIL = r"[A-Za-z0-9_.+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]+"
PHONE = r"\+?[0-9][0-9 ().-]{7,}[0-9]"
NON_WORD = r"[^\p{L}\p{N}_]+"
NUMERIC = r"^\p{N}+$"
SPACES = "".join(map(chr, (*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)))
