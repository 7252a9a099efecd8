"""Default study settings: the four questions and the thirteen constructs."""

from __future__ import annotations

# Themes (questions) and the answer columns they are read from.
THEMES = {
    "Memory": {"enabled": True, "source_columns": ["Memory response - what happened"]},
    "Meaning": {
        "enabled": True,
        "source_columns": ["Meaning response - what the ad was saying"],
    },
    "Emotion": {
        "enabled": True,
        "source_columns": ["Emotion response - feeling and why"],
    },
    "Optimisation": {
        "enabled": True,
        "source_columns": [
            "Optimisation response - one improvement",
            "Why improvement would help",
        ],
    },
}

# The one theme each construct is scored against.
CONSTRUCT_THEMES = {
    "enjoyability": "Emotion",
    "emotional_valence": "Emotion",
    "authenticity": "Emotion",
    "nostalgia": "Emotion",
    "relevance": "Meaning",
    "persuasion": "Meaning",
    "confusion_clarity": "Meaning",
    "scepticism": "Meaning",
    "personal_relevance": "Meaning",
    "narrative_coherence": "Meaning",
    "distinctiveness": "Meaning",
    "branding": "Memory",
    "brand_product_linkage": "Memory",
}

# Anchor phrases of each construct.
ANCHORS = {
    "enjoyability": {
        "enabled": True,
        "phrases": [
            "I really enjoyed watching this ad",
            "This ad was fun and entertaining to watch",
            "Watching this made me smile, I liked it",
            "It was an enjoyable, likeable ad",
            "I had a good time watching this commercial",
            "This ad was pleasant and satisfying to watch",
            "I found this ad delightful",
        ],
    },
    "relevance": {
        "enabled": True,
        "phrases": [
            "This ad is relevant to my life",
            "It speaks to something I actually care about",
            "This felt relevant to people like me",
            "The ad connects with my own situation",
            "This is about something that matters to me personally",
            "I could relate to what the ad was showing",
        ],
    },
    "persuasion": {
        "enabled": True,
        "phrases": [
            "This ad makes me want to buy the product",
            "It convinced me to consider this brand",
            "After watching, I'm more likely to purchase it",
            "The ad gave me a good reason to choose this brand",
            "This made me want to try the product",
            "I feel persuaded to switch to this brand",
        ],
    },
    "branding": {
        "enabled": True,
        "phrases": [
            "The brand was clear and memorable in this ad",
            "I can easily tell which brand this ad is for",
            "The branding stood out strongly throughout",
            "It's obvious this ad belongs to this specific brand",
            "The brand name and logo were well integrated",
            "This ad is clearly and distinctly branded",
        ],
    },
    "confusion_clarity": {
        "enabled": True,
        "phrases": [
            "I was confused about what this ad was trying to say",
            "It wasn't clear what the message was",
            "I didn't understand what was going on",
            "The story was hard to follow",
            "I'm not sure what point the ad was making",
            "The message felt muddled or unclear",
        ],
    },
    "scepticism": {
        "enabled": True,
        "phrases": [
            "This ad felt like it was trying too hard",
            "It came across as forced or fake",
            "The ad felt overly staged and unnatural",
            "It seemed like a gimmick rather than genuine",
            "This felt manipulative or overly salesy",
            "It tried too hard to be emotional or clever",
        ],
    },
    "authenticity": {
        "enabled": True,
        "phrases": [
            "This ad felt genuine and real",
            "It came across as honest and authentic",
            "The story felt true to life, not staged",
            "This felt like a sincere, believable moment",
            "The ad felt natural rather than scripted",
            "It rang true and didn't feel fake",
        ],
    },
    "personal_relevance": {
        "enabled": True,
        "phrases": [
            "This ad feels like it's about people like me",
            "I saw myself in the people in this ad",
            "This represents someone from my community or background",
            "The people in the ad reminded me of myself or my family",
            "This felt made specifically for someone like me",
        ],
    },
    "narrative_coherence": {
        "enabled": True,
        "phrases": [
            "The story had a clear beginning, middle and end",
            "The ad told a coherent, easy-to-follow story",
            "Everything in the ad connected logically",
            "The plot made sense from start to finish",
            "The story flowed naturally and made sense",
        ],
    },
    "emotional_valence": {
        "enabled": True,
        "phrases": [
            "This ad made me feel happy and positive",
            "It evoked strong warm emotions in me",
            "I felt moved and touched watching this",
            "The ad stirred up positive feelings",
            "It made me feel good emotionally",
        ],
    },
    "brand_product_linkage": {
        "enabled": True,
        "phrases": [
            "The product was clearly tied to the brand story",
            "It was obvious how the product fits into the brand's identity",
            "The brand and the product felt tightly connected",
            "I could clearly see the product being used in a brand context",
            "The ad linked the product benefit directly to the brand",
        ],
    },
    "nostalgia": {
        "enabled": True,
        "phrases": [
            "This ad reminded me of my childhood or the past",
            "It felt nostalgic, like something from years ago",
            "This brought back old memories for me",
            "It had a nostalgic, throwback feeling",
            "The ad felt like a callback to an earlier, simpler time",
        ],
    },
    "distinctiveness": {
        "enabled": True,
        "phrases": [
            "This ad felt different from other ads I've seen",
            "It stood out as unique compared to competitors",
            "I haven't seen an ad quite like this before",
            "This felt fresh and distinctive",
            "It was memorable because it was so different",
        ],
    },
}
