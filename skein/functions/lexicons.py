"""Word lists and patterns. Each rule keeps its own list: they differ on purpose.

Patterns are Java regular expressions. ``(?U)`` makes word boundaries, word
characters and white space those of Unicode.
"""

from __future__ import annotations

# --- fixed values: the rules' lists and patterns

#: Step-4 validator: fillers that must not be in an output, outside double quotes.
VALIDATOR_FILLERS = r"(?iU)\b(um|uh|uhh|umm|uh huh)\b"
QUOTED = r'"[^"]*"'
MOJIBAKE = "[�]|Ã[\\x80-\\xbf]|â\\x80|Ã©|Ã¨|Ã¢|Ã®"
THINK_TAG = r"(?i)</?think>"
THINK_BLOCK = r"(?s)<think>.*?</think>"
REPLACEMENT = "�"

#: Generation validator.
GENERATION_FILLERS = r"(?iU)\b(?:um|uh|uh huh|you know|I mean|like basically)\b"

#: Evaluation.
STRONG_FILLERS = r"(?iU)\b(?:um|uh|umm|uhh|hmm|hm|er|erm)\b"
EVALUATION_CORRECTIONS = r"(?iU)\b(?:wait\s+no|scratch\s+that|no\s+wait|I\s+mean(?:t)?)\b"
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten "
    "eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy "
    "eighty ninety hundred thousand million billion"
).split()
EMOJI = r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}\x{2600}-\x{26FF}\x{2700}-\x{27BF}]"

#: Comparison; matched against lower-cased text, so those with a capital I never match.
COMPARE_FILLERS = [
    r"\bum\b",
    r"\buh\b",
    r"\blike\b",
    r"\byou know\b",
    r"\bbasically\b",
    r"\bactually\b",
    r"\bI mean\b",
    r"\bliterally\b",
    r"\bhonestly\b",
    r"\bso\b(?=\s+(?:um|uh|like|the|we|I|it|he|she|they))",
]
OUTPUT_FILLERS = [r"\bum\b", r"\buh\b", r"\byou know\b", r"\bI mean\b", r"\bbasically\b", r"\bliterally\b"]
CORRECTION_MARKERS = [
    r"\bwait no\b",
    r"\bactually\b",
    r"\bI mean\b",
    r"\bscratch that\b",
    r"\blet me rephrase\b",
    r"\bno wait\b",
    r"\bsorry\b",
    r"\bno\s+(?:it\'?s|that\'?s|I meant)\b",
    r"\bwait\b.*\bno\b",
]
MULTI_STEP = r"(?:wait\s+no|no\s+wait|actually|sorry).*(?:wait\s+no|no\s+wait|actually|sorry)"
FALSE_STARTS = r"\.\.\.|—|\w+\s*--\s*"
SPOKEN_NUMBERS = [
    r"\b(?:one|two|three|four|five|six|seven|eight|nine|ten)\b",
    r"\b(?:eleven|twelve|thirteen|fourteen|fifteen|sixteen|seventeen|eighteen|nineteen|twenty)\b",
    r"\b(?:thirty|forty|fifty|sixty|seventy|eighty|ninety|hundred|thousand|million|billion)\b",
    r"\bpoint\s+\w+\b",
]
FORMATTED_NUMBER = r"\$[\d,.]+|\d+%|\d{1,3}(?:,\d{3})+|\d+\.\d+"
POSITION_FILLERS = ["um", "uh", "like", "basically", "honestly"]
BULLET, NUMBERED, HEADER = r"(?m)^\s*[-•*]\s", r"(?m)^\s*\d+[.)]\s", r"(?m)^#+\s"

#: Words of four letters and more that do not count as content.
PRESERVATION_STOPWORDS = (
    "like just really actually basically literally "
    "honestly that this with from they them "
    "have been were would could should about "
    "which their there know mean think going "
    "some what when than also very much "
    "well yeah okay"
).split()
#: Words that are no sign of made-up content.
HALLUCINATION_COMMON = (
    "the and for are but not you all can "
    "had her was one our out has his how "
    "its may new now old see way who did "
    "get let say she too use will with that "
    "this from they been have each make like "
    "than them then into just over such take "
    "year also back come made find here more "
    "only well what when your which their there "
    "these about would could should approximately "
    "regarding specifically mentioned discussed noted "
    "included regarding however therefore initial "
    "effective following confirmed estimated current"
).split()

#: Categories by keyword, in the order that breaks ties.
CATEGORY_KEYWORDS = {
    "medical_clinical": "patient diagnosis clinical medication dosage symptom treatment hospital surgery prescription disease therapy".split(),
    "legal_contract": "contract agreement clause hereby whereas provision indemnif liability jurisdiction arbitration statute".split(),
    "technical_code": "function variable algorithm database server compile debug software programming API framework deploy".split(),
    "academic_research": "research study hypothesis methodology findings journal experiment analysis university published".split(),
    "financial_business": "revenue budget fiscal investment quarterly profit dividend financial accounting market stock".split(),
    "recipe_cooking": "recipe ingredient tablespoon teaspoon preheat oven simmer bake cook stir cuisine dish".split(),
    "meeting_notes": ["meeting", "agenda", "minutes", "action item", "attendee", "discuss", "decided", "follow-up", "deadline", "committee", "board"],
    "email_professional": "dear regards sincerely attached forwarding subject memo correspondence notify".split(),
    "creative_writing": "story character narrative novel poem fiction protagonist literary author chapter".split(),
}
#: Share of each category of a synthetic corpus.
CATEGORY_WEIGHTS = {
    "casual_conversation": 0.15,
    "email_professional": 0.12,
    "technical_code": 0.12,
    "medical_clinical": 0.08,
    "legal_contract": 0.08,
    "meeting_notes": 0.10,
    "recipe_cooking": 0.05,
    "academic_research": 0.08,
    "creative_writing": 0.05,
    "financial_business": 0.07,
    "shopping_lists": 0.03,
    "self_corrections_heavy": 0.07,
}
#: Categories whose clean texts may be turned into messy ones, and those of general speech; the others are special to a domain.
CLEAN_TO_MESSY = [
    "medical_clinical", "legal_contract", "technical_code", "academic_research", "financial_business",
    "recipe_cooking", "meeting_notes", "email_professional", "creative_writing",
]
CORE_CATEGORIES = ["casual_conversation", "self_corrections_heavy", "technical_code", "financial_business", "academic_research", "legal_contract"]
#: Criteria of a verdict, and what to do about each when it fails often.
CRITERIA = ["input_realistic", "content_preserved", "no_hallucination", "corrections_applied"]
CRITICAL = ["content_preserved", "no_hallucination"]
SUGGESTIONS = {
    "input_realistic": "Less polished inputs: no punctuation or capitals, numbers in words.",
    "content_preserved": "Keep every fact, instruction, name and number; drop no sentence.",
    "no_hallucination": "Add nothing that the input does not say; change the form only.",
    "corrections_applied": "Remove fillers, format numbers and resolve self-corrections.",
}
