"""Prompt construction: literal, sequential, all-occurrence placeholder replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The prompt template of the deployed configuration (German, as the model sees it).
# ``[values]`` occurs twice on purpose; the sample JSON lacks a comma after "reasoning" as in the original.
PROMPT_TEMPLATE = """Du bist ein wissenschaftlicher Codierer, spezialisiert auf strukturierte Daten.

Analysiere die folgende Fortbildungsbeschreibung für Dozierende an einer Hochschule bzw. Universität:

Titel: [title]
Beschreibung: [description]

Codieranweisungen:
Für die folgende Kategorie sollst du:
1. Einen Wert ([values]) basierend auf Titel und Beschreibung zuweisen
2. Das Kriterium sorgfältig beachten
3. Sorgfältig mit den Ankerbeispielen vergleichen, falls vorhanden.

Kriterium:
[criteria]

Ankerbeispiele:
[examples]

Bitte gib deine Analyse im JSON-Format zurück:
{
    "category": "[category_name]",
    "value": gewählter_wert,
    "confidence": konfidenz_zwischen_0_und_1,
    "reasoning": "kurze Begründung mit Bezug auf Kriterium und Ankerbeispiele"
    "citation": "Zitat aus der Beschreibung passend zur Begründung"
}

Richtlinien:
1. Berücksichtige das Kriterium und die Ankerbeispiele; interpretiere nicht über das explizit genannte hinaus, erlaube aber eine gewissen Spielraum für semantische Ähnlichkeit zum Kriterium
2. Verwende nur die erlaubten Werte: [values]
3. Gib eine Konfidenz zwischen 0 und 1 an
4. Begründe deine Wahl mit Bezug auf das Kriterium
5. Gib nur das JSON-Objekt zurück, keinen zusätzlichen Text"""

# System message and the JSON-format suffix appended to every user message.
SYSTEM_MESSAGE = ("Du bist ein wissenschaftlicher Coder, spezialisiert auf strukturierte Daten. "
                  "Bitte antworte immer im JSON-Format mit den Feldern 'value', 'confidence' und 'reasoning'.")
FORMAT_SUFFIX = ('\n\nBitte antworte im folgenden JSON-Format:\n{\n  "value": "0" oder "1",\n'
                 '  "confidence": Zahl zwischen 0 und 1,\n  "reasoning": "Deine Begründung"\n}')

# Placeholders in replacement order.
PLACEHOLDERS = ["[title]", "[description]", "[category_name]", "[criteria]", "[examples]", "[values]"]


def load_template(spark, path: str, strip: bool = True) -> str:
    """Whole template file (one file that goes into every prompt, read once); the current pipeline strips it."""
    text = "".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    return text.strip() if strip else text


def render_examples(examples: Column) -> Column:
    """``'\\n'.join(f'- {ex}' for ex in examples)``; an empty list gives ''."""
    return F.array_join(F.transform(F.coalesce(examples, F.array().cast("array<string>")),
                                    lambda x: F.concat(F.lit("- "), x)), "\n")


def fill_template(template: Column, title: Column, description: Column, name: Column,
                  criteria: Column, examples_text: Column, values: Column) -> Column:
    """Nested literal ``replace`` in the fixed order: a placeholder inside an earlier substitute is
    expanded by a later step, exactly as sequential ``str.replace`` does. ``$`` and ``\\`` are literal."""
    out = template
    for ph, val in zip(PLACEHOLDERS, [title, description, name, criteria, examples_text, values]):
        out = F.replace(out, F.lit(ph), val)
    return out


def construct_prompt(tasks: DataFrame, template: str = PROMPT_TEMPLATE, name_col: str = "display_name",
                     key_col: str = "category", out: str = "prompt") -> DataFrame:
    """Adds the prompt column. Category name: display name, falling back to the key."""
    p = fill_template(F.lit(template), F.col("title"), F.col("description"),
                      F.coalesce(F.col(name_col), F.col(key_col)), F.col("criteria"),
                      render_examples(F.col("examples")), F.col("values_text"))
    return tasks.withColumn(out, p)


def with_prompt_hash(df: DataFrame, prompt: str = "prompt", out: str = "prompt_hash") -> DataFrame:
    return df.withColumn(out, F.sha2(F.col(prompt), 256))


def build_messages(df: DataFrame, prompt: str = "prompt", with_suffix: bool = True) -> DataFrame:
    """Chat messages: fixed system message + prompt (+ JSON format suffix in the current pipeline)."""
    user = F.concat(F.col(prompt), F.lit(FORMAT_SUFFIX)) if with_suffix else F.col(prompt)
    msgs = F.array(F.struct(F.lit("system").alias("role"), F.lit(SYSTEM_MESSAGE).alias("content")),
                   F.struct(F.lit("user").alias("role"), user.alias("content")))
    return df.withColumn("messages", msgs)


def with_request(df: DataFrame, prompt: str = "prompt") -> DataFrame:
    """``messages`` as the model gets them, and ``prompt_hash`` over all of them: an answer is reused only
    for the same system message, prompt and format suffix."""
    out = build_messages(df, prompt)
    said = F.array_join(F.transform("messages", lambda m: m["content"]), "\n")
    return out.withColumn("prompt_hash", F.sha2(said, 256))


def _first_line_with(text: Column, marker: str) -> Column:
    """The first line of ``text`` that contains ``marker``; NULL when none does.

    That line holds the marker's first occurrence, so it is cut out around that position: no
    array of all lines is built for a prompt that carries a whole text."""
    pos = F.instr(text, marker)
    before = F.substring_index(F.substring(text, F.lit(1), pos - 1), "\n", -1)
    after = F.substring_index(F.substr(text, pos), "\n", 1)
    return F.when(pos > 0, F.concat(before, after))


def extract_prompt_fields(df: DataFrame, prompt: str = "prompt") -> DataFrame:
    """Title and category read back from a prompt (the debug view of a request).

    Title: first line containing ``Titel: `` -> text between its first and second occurrence.
    Category: first line containing ``"category": "`` -> up to the next quote.
    """
    tline = _first_line_with(F.col(prompt), "Titel: ")
    cline = _first_line_with(F.col(prompt), '"category": "')
    title = F.split_part(tline, F.lit("Titel: "), F.lit(2))
    cat = F.split_part(F.split_part(cline, F.lit('category": "'), F.lit(2)), F.lit('"'), F.lit(1))
    return df.withColumns({"prompt_title": F.coalesce(title, F.lit("No title found")),
                           "prompt_category": F.coalesce(cat, F.lit("No category found"))})
