"""Built-in rule sets, sample texts and gold items.

The patterns, their order inside a label and the order of the labels decide the result
of labelling, so they are stated here exactly as rule authors know them.
"""

# Task -> label -> patterns.
BUILT_IN_RULES: dict[str, dict[str, list[str]]] = {
    "sentiment": {
        "Positive": [
            r"\b(love|loved|loving|amazing|awesome|excellent|fantastic|great|wonderful)\b",
            r"\b(perfect|brilliant|outstanding|superb|magnificent|delightful|impressed)\b",
            r"\b(happy|glad|pleased|satisfied|enjoyed|enjoy|thankful|grateful|appreciate)\b",
            r"\b(best|better|improve|improved|recommend|recommended|worth|worthy|value)\b",
            r"\b(fast|quick|smooth|easy|simple|clean|clear|friendly|helpful|useful)\b",
            r"[😊😍🥰😁🤩👍❤️💯✨🎉]",
            r"\b(good|nice|well|cool|fine|decent|solid|reliable|consistent|quality)\b",
        ],
        "Negative": [
            r"\b(terrible|horrible|awful|dreadful|disgusting|hate|hated|worst|bad)\b",
            r"\b(broken|defective|damaged|faulty|useless|worthless|waste|wasted)\b",
            r"\b(slow|delayed|late|never|didn't|won't|doesn't|can't|fail|failed)\b",
            r"\b(disappointed|disappointing|frustrat|annoying|annoyed|angry|upset)\b",
            r"\b(overpriced|expensive|cheap quality|rip.?off|scam|fraud|lie|lying)\b",
            r"\b(poor|weak|mediocre|lacking|missing|broken|crash|error|bug|issue)\b",
            r"[😠😡🤬👎💔😤😞😟]",
            r"\b(refund|return|complaint|problem|issue|wrong|incorrect|mislead)\b",
        ],
        "Neutral": [
            r"\b(okay|ok|alright|average|normal|standard|regular|typical|usual)\b",
            r"\b(neither|both|some|maybe|perhaps|possibly|not sure|unsure|unclear)\b",
            r"\b(review|information|let me know|wondering|question|asking|curious)\b",
        ],
    },
    "intent": {
        "Informational": [
            r"\b(what|why|how|when|where|who|which|explain|tell me|definition|meaning)\b",
            r"\b(learn|understand|know|curious|research|study|read|article|guide|tutorial)\b",
            r"\b(history|cause|reason|fact|statistic|data|information|detail|overview)\b",
        ],
        "Transactional": [
            r"\b(buy|purchase|order|checkout|add to cart|payment|pay|price|cost|cheap)\b",
            r"\b(discount|coupon|promo|deal|offer|sale|subscribe|sign up|register)\b",
            r"\b(download|install|get|free|trial|demo|book|reserve|hire|quote)\b",
        ],
        "Navigational": [
            r"\b(login|log in|sign in|account|profile|dashboard|settings|homepage|official)\b",
            r"\b(website|site|app|platform|portal|link|url|go to|visit|open|launch)\b",
            r"\b(find|locate|search for|where is|contact|support|help center|faq)\b",
        ],
        "Conversational": [
            r"\b(hi|hello|hey|thanks|thank you|please|sorry|excuse me|good morning)\b",
            r"\b(how are you|what's up|nice to meet|talk|chat|discuss|opinion|think)\b",
            r"\b(feel|feeling|recommend|suggest|advice|tip|idea|thought|experience)\b",
        ],
    },
    "content_category": {
        "Spam": [
            r"\b(click here|limited offer|act now|earn money|make money fast|winner)\b",
            r"\b(free gift|100% free|no risk|guaranteed|prize|lottery|selected)\b",
            r"(https?://\S+){3,}",
            r"(\$\d+){2,}",
            r"\b(follow back|follow for follow|f4f|sub4sub|like4like)\b",
        ],
        "Hate Speech": [
            r"\b(hate|kill|destroy|eliminate)\s+(all|every|those)\b",
            r"\b(inferior|superior race|subhuman|vermin|parasite)\b",
            r"\b(go back to|not welcome|don't belong|outsider)\b",
        ],
        "Violence": [
            r"\b(bomb|explode|shoot|stab|kill|murder|attack|threat|assault)\b",
            r"\b(weapon|gun|knife|poison|harm|hurt|injure|wound|torture)\b",
            r"\b(riot|mob|gang|terror|extremis|radicali)\b",
        ],
        "Misinformation": [
            r"\b(fake news|hoax|conspiracy|they don't want you to know|secret cure)\b",
            r"\b(proven by scientists but hidden|government hiding|cover.?up|truth they hide)\b",
            r"\b(miracle cure|100% effective|no side effects|doctors hate)\b",
        ],
        "NSFW": [
            r"\b(nsfw|adult content|18\+|explicit|mature|x.?rated)\b",
        ],
        "Safe": [
            r"\b(hello|thank|welcome|nice|enjoy|share|help|learn|create|build)\b",
            r"\b(news|update|event|product|service|review|feedback|story|article)\b",
        ],
    },
}

# Sample e-commerce rule set, as a user would supply it in a JSON file.
SHOP_RULES: dict[str, list[str]] = {
    "Product Inquiry": [
        r"\b(what|does|is|are|can|will|how big|how much|dimensions|compatible|suitable)\b",
        r"\b(specifications|specs|features|material|colour|color|size|weight|warranty)\b",
        r"\?$",
    ],
    "Purchase Intent": [
        r"\b(buy|order|purchase|checkout|payment|paying|want to get)\b",
        r"\b(price|cost|how much|discount|promo|coupon|deal|offer|sale)\b",
        r"\b(stock|available|in stock|when will|restock|back in stock)\b",
    ],
    "Post-Purchase Review": [
        r"\b(received|arrived|delivered|just got|unboxed|opened|using|been using|after)\b",
        r"\b(review|rating|stars|feedback|verdict|thoughts|opinion|experience)\b",
        r"\b(recommend|worth|value for money|good buy|bad buy|regret)\b",
    ],
    "Complaint or Return": [
        r"\b(broken|defective|damaged|wrong|missing|incomplete|not working)\b",
        r"\b(refund|return|replace|exchange|complaint|issue|problem|dispute)\b",
        r"\b(contact support|customer service|where is my order|tracking)\b",
    ],
    "General Comment": [
        r"\b(hi|hello|thanks|thank you|great|nice|ok|okay|fine|just|random)\b",
        r"\b(by the way|btw|also|note|reminder|update|just saying)\b",
    ],
}

# Function words of four languages, used with the driver tables (order is the tie-break).
LANGUAGE_RULES: dict[str, list[str]] = {
    "en": [r"\b(the|and|of|to|that|with)\b"],
    "fr": [r"\b(le|la|les|des|une)\b", r"\b(que|qui|dans|est)\b"],
    "de": [r"\b(der|die|und|das)\b", r"\b(ein|den|von|mit)\b"],
    "es": [r"\b(el|los|una)\b", r"\b(que|las|por|con)\b"],
}

# Seed texts of the sample generator, in cycling order.
SAMPLE_TEXTS: dict[str, list[str]] = {
    "sentiment": [
        "This product is absolutely amazing! Best purchase I've made this year. 😍",
        "Terrible quality. Broke after 2 days. Complete waste of money. 😠",
        "It's okay. Nothing special, but does the job.",
        "Fantastic customer service! They resolved my issue in minutes.",
        "Never buying from this store again. Shipment was 3 weeks late!",
        "Mediocre product. Average at best.",
        "Exceeded all my expectations. Outstanding build quality!",
        "Disappointed with the packaging but the product itself is decent.",
        "Great value for money. Highly recommend to anyone looking for a budget option.",
        "The item arrived damaged. Very frustrated with this experience.",
        "Perfect for my needs. Simple, clean design and works perfectly.",
        "Not sure about this one. It has both good and bad aspects.",
        "Absolutely love it! Would give 6 stars if I could! 💯",
        "Poor customer support. Took 3 weeks to get a response.",
        "Solid product. Nothing extraordinary but reliable and consistent.",
    ],
    "intent": [
        "What is the capital city of Brazil?",
        "Buy cheap laptops online free shipping",
        "Log in to my account dashboard",
        "Hey! Can you recommend a good restaurant near me?",
        "How does machine learning work?",
        "Order iPhone 15 Pro Max with discount code",
        "Sign up for the free trial today",
        "Where is the official help center website?",
        "Why is the sky blue? Explain the science.",
        "Download the mobile app for free",
        "Hello, how are you today?",
        "Best Python tutorial for beginners 2024",
        "Reset my password account settings",
        "Limited offer: get 50% off all products now",
        "What are the causes of climate change?",
    ],
    "content_category": [
        "EARN $5000 A WEEK FROM HOME! Click here NOW! Limited offer! 🤑",
        "Check out this amazing recipe for chocolate chip cookies!",
        "Scientists HATE this one trick that cures all diseases!",
        "Had a great time at the local farmers market today 🌺",
        "New update: our app now supports dark mode. Download v2.1 today.",
        "FREE GIFT for the first 100 subscribers! Act now! No risk!",
        "Reminder: community meeting tonight at 7pm in the main hall.",
        "The government is hiding the real data about this virus!",
        "Beautiful sunset at the beach today 🌅 Nature is amazing.",
        "WIN WIN WIN! You have been selected for our lottery prize!",
        "Workshop registration open: Python for Data Science - free seats",
        "Doctors hate him for discovering this miracle cure with no side effects",
        "Team lunch today was great! Thanks everyone for coming 🎉",
        "ADULT CONTENT 18+ — mature themes ahead",
        "Our quarterly results are now published on the investor relations page.",
    ],
}

# Gold items per task, (source_id, text, final_label).
GOLD_ITEMS: dict[str, list[tuple[str, str, str]]] = {
    "sentiment": [
        ("g001", "This product exceeded my expectations completely. Love it!", "Positive"),
        ("g002", "Worst purchase of my life. Totally broken on arrival.", "Negative"),
        ("g003", "It is fine. Neither great nor terrible.", "Neutral"),
        ("g004", "Amazing quality, amazing service, amazing experience!", "Positive"),
        ("g005", "I want a refund. This is not what was described.", "Negative"),
        ("g006", "Average product. Does what it says.", "Neutral"),
        ("g007", "Absolutely fantastic! I recommend this to everyone!", "Positive"),
        ("g008", "Delayed shipping, poor packaging, bad product.", "Negative"),
        ("g009", "Not bad, not great. About what I expected.", "Neutral"),
        ("g010", "Five stars! Perfect in every way. Will buy again!", "Positive"),
    ],
    "intent": [
        ("g001", "What is machine learning?", "Informational"),
        ("g002", "Buy discounted laptop online free delivery", "Transactional"),
        ("g003", "Login to my account", "Navigational"),
        ("g004", "Hey, any restaurant recommendations near me?", "Conversational"),
        ("g005", "Explain how neural networks work step by step", "Informational"),
        ("g006", "Subscribe to premium plan with 20% discount", "Transactional"),
        ("g007", "Go to the official Apple support page", "Navigational"),
        ("g008", "Hi there! I was wondering what you think about AI?", "Conversational"),
        ("g009", "History of the Roman Empire", "Informational"),
        ("g010", "Download free ebook now", "Transactional"),
    ],
    "content_category": [
        ("g001", "Earn money fast with this simple trick! Click here!", "Spam"),
        ("g002", "Today we visited the botanical garden. Beautiful flowers! 🌸", "Safe"),
        ("g003", "Scientists discovered they don't want you to know this cure!", "Misinformation"),
        ("g004", "Our office is closed on Monday for a public holiday.", "Safe"),
        ("g005", "Win a free iPhone! You've been selected — act now!", "Spam"),
        ("g006", "Join us for the community cleanup drive this Saturday.", "Safe"),
        ("g007", "100% guaranteed cure with no side effects doctors hate him", "Misinformation"),
        ("g008", "Recipe of the week: homemade pasta with basil pesto", "Safe"),
        ("g009", "F4F follow back instantly guaranteed", "Spam"),
        ("g010", "Team outing at the lake was so much fun! Great weather too.", "Safe"),
    ],
}
