"""Words, templates, markers and corpus settings that results depend on."""

# ---------------------------------------------------------------------------
# Prompt catalogue
# ---------------------------------------------------------------------------

AUTHORS = [
    "Dr. Seuss", "William Shakespeare", "Tupac Shakur", "J.K Rowling", "Stephen King", "JRR Tolkien",
    "Paulo Coelho", "Taylor Swift", "Shakespeare", "Jane Austen", "Charles Dickens", "Mark Twain",
]

STYLES = ["sea shanty", "rap song", "poem", "haiku", "limerick", "sonnet", "ballad", "ode", "epic"]

PERIODS = [
    "Victorian era", "Elizabethan era", "Renaissance", "Medieval", "Ancient Greek", "Ancient Roman",
    "Middle Ages", "Enlightenment", "Baroque", "Romantic", "Modernist", "Postmodernist",
]

CHARACTERS = [
    "magician", "wizard", "necromancer", "witch", "warrior", "knight", "sorcerer", "elf", "dwarf", "dragon",
    "king", "priest", "queen", "prince", "princess", "vampire", "werewolf", "zombie", "ghost", "demon",
    "angel", "fairy", "mermaid", "pirate", "ninja", "samurai", "cowboy", "detective", "spy", "superhero",
    "villain", "monster", "robot", "alien", "time traveler", "space explorer", "adventurer", "explorer",
    "scientist", "inventor", "artist", "musician", "poet", "writer", "philosopher", "scholar", "historian",
    "journalist", "reporter", "blogger", "critic", "activist", "politician", "leader", "rebel",
    "revolutionary", "anarchist", "capitalist",
]

AUTHOR_TEMPLATES = [
    "Rewrite this essay but do it using the writing style of {author}.",
    "Transform this text as if it was written by {author}.",
    "Imagine {author} was to rewrite this text, what would it be like.",
]

STYLE_TEMPLATES = [
    "Rewrite this text in the style of a {style}.",
    "Transform this in to a {style}.",
    "How would you rewrite this text in the style of a {style}.",
]

PERIOD_TEMPLATES = [
    "Rewrite the text as if it were written during the {period} historical period.",
    "Transform this text using language and cultural references appropriate to the {period} time period",
]

IMPROVE_TEMPLATES = [
    "Improve this text by adding a {character} twist.",
    "Improve this text by adding a {character}.",
    "Improve this text by rewriting it from the perspective of a {character}.",
]

BASIC_PROMPTS = [
    "Improve the text.",
    "Make this text better.",
    "Rewrite this essay.",
    "Improve this essay.",
    "Make this essay better.",
    "Summarize this text.",
    "Rewrite the text using formal language suitable for an academic journal.",
    "Create a compelling plot that engages the reader.",
    "Rewrite the text in a humorous tone, using wit, sarcasm, and comedic elements.",
    "Use rhetorical devices and persuasive language techniques.",
    "Rewrite the text as if you're having a friendly conversation with a reader.",
    "Rewrite the text using poetic language, imagery, and metaphors.",
    "Focus on creating a rhythmic flow and evoking emotions through language.",
    "Recast the text using poetic language, metaphors, and imagery to create a rhythmic and evocative piece of writing.",
    "Rewrite the text as a travelogue, describing experiences, sights, and sounds in vivid detail to transport the reader to different locations.",
]

# family -> (values, templates); the catalogue is every value in every template
CATALOGUE = {
    "author": (AUTHORS, AUTHOR_TEMPLATES),
    "style": (STYLES, STYLE_TEMPLATES),
    "period": (PERIODS, PERIOD_TEMPLATES),
    "basic": (BASIC_PROMPTS, ["{prompt}"]),
    "improve": (CHARACTERS, IMPROVE_TEMPLATES),
}

# ---------------------------------------------------------------------------
# Templates for generation inputs
# ---------------------------------------------------------------------------

REWRITE_TEMPLATES = [
    "{rewrite_prompt} {original_text}",
    "Given the prompt: {rewrite_prompt}, rewrite the following text: {original_text}",
    "Given the prompt: {rewrite_prompt}, rewrite the following text, don't mention anything about the task at hand: {original_text}",
]

INSTRUCTION_TEMPLATE = "<start_of_turn>user\n{prompt}<end_of_turn>\n<start_of_turn>model\n"

POLLUTION_QUESTION = "Does the following text contain the information {prompt}? {text}"

EMPTY_GENERATION = "EMPTY"

# ---------------------------------------------------------------------------
# Templates for instruct and chat examples
# ---------------------------------------------------------------------------

QUERY_TEMPLATES = [
    "Given the original text: {original_text} \n It has been rewritten to: {rewritten_text}. \n Please provide the prompt used to rewrite the text.",
    "### Original Text: {original_text} ### Rewriten Text: {rewritten_text}",
    "Guess what prompt has been used to rewrite the original text: {original_text}\n, Rewritten text: {rewritten_text}",
]

SYSTEM_PROMPTS = [
    "You are an LLM trying to predict the prompt used to rewrite the text",
    "You are tasked with predicting the prompt used to rewrite the text",
]

MOCK_SYSTEM_REPLY = "Understood, I will follow your instructions."

BASE_MARKER = "###Prompt Used"
START_RESPONSE = "Prompt Used:"
ORIGINAL_PREFIX = "Original Text:"
REWRITTEN_PREFIX = "Re-written Text:"
REPLY_TO_ORIGINAL = "Provide the new text and I will tell you what new element was added or change in tone was made to improve it - with no references to the original.  I will avoid mentioning names of characters.  It is crucial no person, place or thing from the original text be mentioned.  For example - I will not say things like 'change the puppet show into a book report' - I would just say 'improve this text into a book report'.  If the original text mentions a specific idea, person, place, or thing - I will not mention it in my answer.  For example if there is a 'dog' or 'office' in the original text - the word 'dog' or 'office' must not be in my response.  My answer will be a single sentence."

# ---------------------------------------------------------------------------
# Thresholds and sizes
# ---------------------------------------------------------------------------

MAX_WORDS = 150
PROMPTS_PER_TEXT = 4
CLUSTERS = 10
CLUSTER_SEED = 42
SAMPLE_PER_SPLIT = 1500
SPLIT_SHARES = [("train", 0.8), ("validation", 0.1), ("test", 0.1)]
ALLOWED_LABELS = ["tweet", "news", "story"]
ENGLISH_THRESHOLD = 0.95
POLLUTION_THRESHOLD = 0.5
REPAIR_THRESHOLD = 0.7
SKIP_PROBABILITY = 0.5
COSINE_FLOOR = 1e-8

# ---------------------------------------------------------------------------
# Corpora (config name, dataset name, key columns, splits)
# ---------------------------------------------------------------------------

CORPORA = [
    ("writtingprompts", "euclaise/writingprompts", ["story"], ["train", "validation", "test"]),
    ("openwebtext", "Skylion007/openwebtext", ["text"], ["train"]),
    ("multi_news", "multi_news", ["summary"], ["train", "validation", "test"]),
    ("english-poems", "sadFaceEmoji/english-poems", ["poem"], ["train"]),
    (
        "story_cloze-2016",
        "gimmaru/story_cloze-2016",
        ["input_sentence_1", "input_sentence_2", "input_sentence_3", "input_sentence_4"],
        ["test"],
    ),
    ("poem_sentiment", "poem_sentiment", ["verse_text"], ["train", "validation", "test"]),
    ("Refined-Anime-Text", "CausalLM/Refined-Anime-Text", ["text"], ["train"]),
    (
        "text_summarization_long_short_text_2000",
        "sujayC66/text_summarization_long_short_text_2000",
        ["summary"],
        ["train", "test"],
    ),
]

# Cells that a CSV source holds for "missing"
MISSING_CELLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Characters that a Unicode-aware strip removes
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
