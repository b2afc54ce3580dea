"""Word lists, lookup tables, templates and message texts."""

# --- Fixed values: results depend on these exact words, so they are stated as they are. ---

TOXIC_WORDS = ("idiot", "stupid", "trash", "worst", "hate", "scam", "cringe")

SIGNAL_PHRASES = (
    "launch", "announcement", "preorder", "drop", "collab", "ugc", "giveaway", "challenge",
    "comment below", "subscribe", "link in bio", "waitlist", "cpm", "cpc", "roas", "conversion", "retarget",
    "short-form", "reel", "short", "story", "carousel", "duet", "stitch", "brand deal", "referral",
    "limited time", "discount", "early access",
)

POSITIVE_WORDS = ("great", "love", "awesome", "useful", "works")
NEGATIVE_WORDS = ("hate", "worst", "useless", "broken")

DOMAIN_STOP_WORDS = tuple(
    """
    just like people think time make made really know got going much many also one get even good well
    thing things want see look little lot ive im youre hes shes theyre cant dont wont didnt isnt wasnt
    video channel watch show episode guy guys hey oh hmm uh huh lol lmao omg stuff kind sorta
    """.split()
)

BRAND_HINTS = {
    "google": "Google", "apple": "Apple", "meta": "Meta", "facebook": "Facebook", "instagram": "Instagram",
    "tiktok": "TikTok", "youtube": "YouTube", "linkedin": "LinkedIn", "openai": "OpenAI",
    "microsoft": "Microsoft", "amazon": "Amazon", "x": "Twitter", "twitter": "Twitter", "snap": "Snapchat",
    "spotify": "Spotify", "netflix": "Netflix", "adobe": "Adobe",
}

VERTICAL_HINTS = {
    "music": "Music", "song": "Music", "artist": "Music", "pricing": "Pricing", "price": "Pricing",
    "ads": "Advertising", "ad": "Advertising", "cpc": "Advertising", "campaign": "Advertising",
    "ux": "UX", "ui": "UX", "design": "Design", "seo": "SEO", "search": "SEO",
    "product": "Product", "feature": "Product", "brand": "Branding", "branding": "Branding",
    "marketing": "Marketing", "market": "Marketing", "ai": "AI", "llm": "AI", "model": "AI",
    "video": "Video", "shorts": "Video", "reel": "Video", "creator": "Creator", "influencer": "Creator",
    "startup": "Startup", "founder": "Startup",
}

CAPTION_TEMPLATES = (
    "Key take: {snippet}",
    'People say: "{snippet}" — this made us think about [topic]',
    "Hot take: {snippet} — what do you think?",
    "Short: {snippet}",
)

PROMPT_TEMPLATE = (
    "You are a marketing copywriter.\n"
    "Goal: Create one short social caption (<=50 words) + a 1-line CTA for platform={platform}.\n"
    "Tone should match sentiment: {sentiment}.\n"
    "Topic name: {topic}\n"
    "Representative audience comments (signal): {sample}\n\n"
    "Return strictly in the format: caption || CTA"
)

RANK_PROMPT_HEAD = (
    "You are a marketing analyst. Rank the following variants by expected CTR (highest first). "
    "Return a JSON array of objects: {variant_id, score, reason}.\n\n"
    "History:\n"
)

RANK_CTA_WORDS = ("buy", "subscribe", "click", "signup")
PRIOR_CTA_WORDS = ("buy", "cta", "click", "signup")
AI_WORDS = ("ai", "openai", "gpt")

DQ_REASONS = ("lang_other", "toxicity_gt_0.30", "ed_lt_0.20", "no_signal_or_hashtag")

# --- End of the fixed values. The lists below are this library's own. ---

ENGLISH_STOP_WORDS = tuple(
    """
    a about above after again against all am an and any are as at be because been before being below between
    both but by can cannot could did do does doing down during each either else ever every few for from further
    had has have having he her here hers herself him himself his how however i if in into is it its itself
    may me might mine more most must my myself neither no nor not now of off on once only or other our ours
    ourselves out over own per rather same shall she should since so some such than that the their theirs them
    themselves then there therefore these they this those through thus to together too toward towards under
    until up upon us very via was we were what when where whether which while who whom whose why will with
    within without would yet you your yours yourself yourselves
    """.split()
)

NEGATORS = (
    "not", "no", "never", "none", "nobody", "nothing", "neither", "nor", "cannot", "without",
    "can't", "don't", "doesn't", "didn't", "isn't", "wasn't", "won't", "wouldn't", "shouldn't", "couldn't",
    "aren't", "weren't", "hasn't", "haven't", "hadn't", "cant", "dont", "doesnt", "didnt", "isnt", "wasnt", "wont",
)
