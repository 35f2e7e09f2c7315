"""Rule tables as data. Patterns, weights, levels and names that results depend on."""

from __future__ import annotations

from siltstone.operators.rules import Rule

# What makes a source unfixable, and how surely.
LEVELS = ["fixable", "likely_unfixable", "definitely_unfixable"]
UNFIXABLE = [
    Rule("external_dependency_cv2", r"import\s+cv2|from\s+cv2\s+import", LEVELS[2], category="external_dependency", explanation="OpenCV (cv2) is not available in ManimCE environment"),
    Rule("external_dependency_displayer", r"import\s+displayer|from\s+displayer\s+import", LEVELS[2], category="external_dependency", explanation="displayer is a custom module not available in ManimCE"),
    Rule("external_dependency_pygame", r"import\s+pygame|from\s+pygame\s+import", LEVELS[2], category="external_dependency", explanation="pygame is not part of ManimCE"),
    Rule("pi_creature_call", r"\b(ThoughtBubble|SpeechBubble|Face|PiCreature|Randolph|Mortimer|Mathematician)\s*\(", LEVELS[2], category="pi_creature", explanation="Pi Creature animation system is not available in ManimCE"),
    Rule("pi_creature_reference", r"\b(randy|mortimer|randolph|pi_creature)\s*\.", LEVELS[2], category="pi_creature", explanation="Pi Creature character references not available in ManimCE"),
    Rule("custom_inheritance", r"class\s+\w+\s*\((CycloidScene|PathSlidingScene|MultilayeredScene|PhotonScene|ThetaTGraph|VideoLayout)\)", LEVELS[1], category="custom_inheritance", explanation="Inherits from custom scene class not in ManimCE"),
    Rule("continual_animation", r"class\s+\w+\s*\(.*ContinualAnimation.*\)", LEVELS[1], category="continual_animation", explanation="ContinualAnimation has no direct ManimCE equivalent"),
    Rule("syntax_corruption", r"^SyntaxError:\s+invalid\s+syntax\s+at\s+line\s+1", LEVELS[2], literal=True, category="syntax_corruption", explanation="AST transformation produced structurally broken code"),
    Rule("complex_config", r"CONFIG\s*=\s*\{[^}]*lambda[^}]*\}", LEVELS[1], category="complex_config", explanation="CONFIG contains lambda functions requiring manual refactoring"),
    Rule("missing_class", r"NameError:\s+name\s+['\"]ParametricCurve['\"]\s+is\s+not\s+defined", LEVELS[1], category="missing_class", explanation="ParametricCurve requires specific ManimCE implementation"),
    Rule("glsl_shader", r"\.glsl|shader_wrapper|ShaderWrapper", LEVELS[2], category="glsl_shader", explanation="GLSL shaders are not supported in ManimCE"),
    Rule("complex_3d", r"class\s+\w+\s*\(.*ThreeDScene.*\).*CONFIG.*camera_config", LEVELS[1], category="complex_3d", explanation="Complex 3D camera configurations may not translate to ManimCE"),
    Rule("interactive_scene", r"on_mouse_motion|on_mouse_press|on_key_press|mouse_drag_point|InteractiveScene", LEVELS[2], category="interactive_scene", explanation="Interactive scenes require live OpenGL window and cannot be pre-rendered as videos"),
    Rule("direct_opengl", r"moderngl\.|TRIANGLE_STRIP|direct.*opengl", LEVELS[2], category="direct_opengl", explanation="Direct OpenGL calls are not supported in ManimCE"),
]

# Patterns that lower the confidence in a systematic conversion, by priority; weight is the impact.
HIGH_RISK = [
    Rule("complex_list_unpacking", r"([a-zA-Z_][a-zA-Z0-9_]*\s*,\s*){2,}[a-zA-Z_][a-zA-Z0-9_]*\s*=\s*\[", "high", 0.3),
    Rule("nested_list_operations", r"\[\s*\[.*\]\s*\]", "low", 0.1, fast=r"\A(?>.*?\[\s*\[).*?\]\s*\]"),
    Rule("list_comprehension_complex", r"\[.*for.*for.*\]", "low", 0.1, fast=r"\A(?>.*?\[)(?>.*?for)(?>.*?for).*?\]"),
    Rule("complex_function_calls", r"\w+\([^)]*\([^)]*\)[^)]*\)", "medium", 0.2),
    Rule("nested_method_chains", r"\w+\([^)]*\)\.[a-zA-Z_][a-zA-Z0-9_]*\([^)]*\)", "low", 0.1),
    Rule("complex_tex_expressions", r"(Tex|MathTex|TextMobject|OldTex)\([^)]*[\[\]{}\\][^)]*\)", "high", 0.3),
    Rule("latex_with_variables", r"(Tex|MathTex|TextMobject|OldTex)\([^)]*%[sdf][^)]*\)", "low", 0.1),
    Rule("nested_animations", r"(Transform|ReplacementTransform)\([^)]*VGroup[^)]*\)", "medium", 0.2),
    Rule("complex_animation_chains", r"(self\.play|self\.add)\([^)]*,[^)]*,[^)]*,[^)]*\)", "low", 0.1, fast=r"(self\.play|self\.add)\((?>[^),]*+,){3}[^)]*+\)"),
    Rule("nested_conditionals", r"if.*:\s*\n\s+if.*:", "low", 0.1, fast=r"\A(?>.*?if).*?:\s*\n\s+if.*?:"),
    Rule("complex_loops", r"for.*in.*:\s*\n\s+for.*in.*:", "low", 0.1, fast=r"\A(?>.*?for)(?>.*?in).*?:\s*\n\s+for(?>.*?in).*?:"),
    Rule("unclosed_parentheses_risk", r"\([^)]*\([^)]*$", "high", 0.3, fast=r"\([^()]*+\([^)\n]*+$"),
    Rule("missing_comma_risk", r"\[[^,\]]{20,}\]", "low", 0.1),
]

#: What ends a line for . and $, and what leads from the end of a line over white space to an indented one.
_ENDS, _INDENT = r"\n\r\x85\u2028\u2029", r"(?=[^\S\n]*+\n\s)\s++"
#: From the start of a text or what follows a closing parenthesis, up to the first opening one that follows a word; and on to the next such one.
_OPEN = r"(?:[^()]*+\((?<!\w\())*+[^()]*+\("

# What makes a source complex; weight is what an occurrence counts.
COMPLEXITY = [
    Rule("nested_conditionals", r"if.*:\s*\n\s+if.*:", weight=3, linear=rf"^(?>.*?if)(?>.*:){_INDENT}if(?>.*:)"),
    Rule("complex_loops", r"for.*in.*:\s*\n\s+.*for.*in.*:", weight=3, linear=rf"^(?>.*?for)(?>.*?in)(?>.*:){_INDENT}(?>.*?for)(?>.*?in)(?>.*:)"),
    Rule("nested_function_calls", r"\w+\([^)]*\w+\([^)]*\)[^)]*\)", weight=2, linear=rf"(?:\A|\)){_OPEN}{_OPEN}[^)]*+\)[^)]*+(?=\))"),
    Rule("complex_list_comprehensions", r"\[.*for.*for.*\]", weight=2, linear=r"^(?>.*?\[)(?>.*?for)(?>.*?for)(?>.*\])"),
    Rule("multiple_inheritance", r"class\s+\w+\([^)]*,.*\):", weight=1, linear=r"class\s++\w++\((?>[^)]*,)(?>.*\):)"),
    Rule("lambda_expressions", r"lambda\s+[^:]+:", weight=1, linear=r"lambda\s[^:]++:"),
    Rule("functions", r"def\s+\w+", weight=1, linear=r"def\s++\w++"),
    Rule("classes", r"class\s+\w+", weight=1, linear=r"class\s++\w++"),
]

# Patterns of converted code that fail when it runs.
RUNTIME = [
    Rule("tex_list_args", r"(Tex|MathTex|TextMobject|OldTex)\s*\(\s*\[", linear=r"Tex(?:tMobject)?+\s*+\(\s*+\["),
    Rule("vgroup_list_args", r"VGroup\s*\(\s*\[", linear=r"VGroup\s*+\(\s*+\["),
    Rule("missing_constants", r"\b(DL|DR|UL|UR|FRAME_WIDTH|FRAME_HEIGHT)\b", linear=r"(?=[DUF])\b(?:[DU][LR]|FRAME_(?:WIDTH|HEIGHT))\b"),
    Rule("old_method_calls", r"\.(get_center|get_width|get_height|get_color)\s*\(\s*\)", linear=r"\.get_(?:center|width|height|color)\s*+\(\s*+\)"),
    Rule("points_access", r"\.points\["),
    Rule("undefined_functions", r"[a-zA-Z_][a-zA-Z0-9_]*\s*\([^)]*\)(?=.*# undefined)", linear=r"(?:\A|(?<=\)))(?>[^)]*?[a-zA-Z_][a-zA-Z0-9_]*+\s*+\()[^)]*+\)(?=.*# undefined)", needs="# undefined"),
    Rule("string_formatting_issues", r"[^r]\"[^\"]*\\[^nr]"),
]

# Likely damage in source text.
PROBLEMATIC = [
    Rule("unclosed_parentheses", r"\([^)]*$", linear=r"^(?>.*\)|)(?>.*?\()[^)]*$"),
    Rule("unmatched_brackets", r"\[[^\]]*$", linear=r"^(?>.*\]|)(?>.*?\[)[^\]]*$"),
    Rule("missing_commas", r"\[[^,\]]{30,}\]", linear=r"(?:\A|[,\]])[^\[\],]*+\[[^,\]]{30,}+(?=\])"),
    Rule("malformed_f_strings", r"f[\"'][^\"']*\{[^}]*$", linear=rf"f[\"'][^\"']*\{{(?=[^}}{_ENDS}]*+$)[^}}]*$"),
]

# Categories of error messages, in the order they are tried.
ERROR_CATEGORIES = [
    ("import_error", [r"ImportError.*'(\w+)'", r"cannot import name '(\w+)'", r"No module named '(\w+)'"]),
    ("name_error", [r"NameError.*'(\w+)' is not defined", r"name '(\w+)' is not defined"]),
    ("attribute_error", [r"AttributeError.*'(\w+)' object has no attribute '(\w+)'", r"'(\w+)' has no attribute '(\w+)'"]),
    ("type_error", [r"TypeError.*(\w+)\(\) takes", r"TypeError.*missing \d+ required positional argument", r"TypeError.*unexpected keyword argument"]),
    ("syntax_error", [r"SyntaxError: (.+)", r"IndentationError: (.+)"]),
    ("animation_error", [r".*Animation.*not found", r".*ShowCreation.*", r".*ContinualAnimation.*"]),
    ("color_constant_error", [r".*COLOR_MAP.*", r".*color.*not defined"]),
    ("method_not_found", [r".*has no attribute '(get_\w+|set_\w+)'", r".*method.*not found"]),
    ("config_error", [r".*CONFIG.*", r".*config.*error"]),
    ("pi_creature_error", [r".*PiCreature.*", r".*Randolph.*", r".*Mortimer.*"]),
]

# Ladders of words for error messages and render output, in the order they are tried.
ERROR_LADDER = [
    ("import_error", ["import"]),
    ("attribute_error", ["attribute"]),
    ("undefined_name", ["name", "not defined"]),
    ("syntax_error", ["syntax"]),
    ("type_error", ["type"]),
    ("color_error", ["color"]),
    ("animation_error", ["animation"]),
]

# Renames of classes, animations and colours.
RENAMES = [
    (r"\bTextMobject\b", "Text"),
    (r"\bTexMobject\b", "MathTex"),
    (r"\bTexText\b", "Tex"),
    (r"\bOldTexText\b", "Text"),
    (r"\bShowCreation\b", "Create"),
    (r"\bCircleIndicate\b", "Indicate"),
    (r"\bShowCreationThenDestruction\b", "ShowPassingFlash"),
    (r"\bShowCreationThenFadeOut\b", "ShowPassingFlash"),
    (r"\bCOLOR_MAP\b", "MANIM_COLORS"),
    (r"\bLIGHT_GRAY\b", "LIGHT_GREY"),
    (r"\bDARK_GRAY\b", "DARK_GREY"),
    (r"\bGRAY\b", "GREY"),
]

# Fixes of converted code, applied one after another. (pattern, replacement with $n groups)
_TEX = r"Tex\s*\(\s*['\"]"
_MATH = "MathTex(r\"$1\""
RUNTIME_FIXES = [
    (r"(\w+)\.get_center\(\)(\s*[+\-*/])", "$1.center$2"),
    (_TEX + r"([^'\"]*\\\\frac[^'\"]*)['\"]", _MATH),
    (_TEX + r"([^'\"]*\\\\cdot[^'\"]*)['\"]", _MATH),
    (_TEX + r"([^'\"]*\\\\sum[^'\"]*)['\"]", _MATH),
    (_TEX + r"([^'\"]*\\\\int[^'\"]*)['\"]", _MATH),
    (_TEX + r"([^'\"]*\\\\\w+[^'\"]*)['\"]", _MATH),
    (_TEX + r"\\\\frac\{%[sd]\}\{%[sd]\}['\"]", r'MathTex(r"\\frac{%s}{%s}"'),
    (_TEX + r"([^'\"]*\\\\frac\{[0-9]+\}\{[0-9]+\}[^'\"]*)['\"]", _MATH),
    (r"MathMathTex\s*\(", "MathTex("),
    (r"MathTex\s*\(\s*['\"]r\"\\\\([^'\"]*)\"\s*%", r'MathTex(r"\\\\frac{%d}{%d}" %'),
    (r"MathTex\s*\(\s*['\"]r\"\\\\frac\{[^}]*\}\{[^}]*\}\"['\"]", r'MathTex(r"\\\\frac{%d}{%d}"'),
    (r"Tex\s*\(\s*s\s*\)", "MathTex(s)"),
    (_TEX + r"([^'\"]*\\\\frac\{[^}]+\}\{[^}]+\}[^'\"]*)['\"]", _MATH),
    (r"(\w+)\.points\[0\]", "$1.get_start()"),
    (r"(\w+)\.points\[-1\]", "$1.get_end()"),
    (r"\.shift\(([^)]+) - ([^)]+)\.points\[0\]\)", ".shift($1 - $2.get_start())"),
    (r"(\w+)\.get_width\(\)(\s*[+\-*/])", "$1.width$2"),
    (r"(\w+)\.get_height\(\)(\s*[+\-*/])", "$1.height$2"),
]

# Terms that prompts are enriched with, and modules of the standard library.
MATH_TERMS = ["integral", "derivative", "matrix", "vector", "function", "equation", "polynomial", "exponential", "logarithm", "trigonometric", "binary", "decimal", "hexadecimal", "algorithm"]
TECH_TERMS = ["animation", "transform", "rotate", "scale", "shift", "morph", "interpolate", "fade", "draw", "create", "update"]
STDLIB = ["os", "sys", "math", "random", "json", "time", "datetime", "collections", "itertools", "functools", "copy", "re", "ast", "pathlib", "typing", "dataclasses", "abc", "enum", "warnings", "logging", "subprocess", "multiprocessing", "threading"]
THIRD_PARTY = ["numpy", "scipy", "matplotlib", "PIL", "cv2", "pygame"]

# Boosts of the fixer's confidence by the first word a fix's name holds.
BOOSTS = [("import", 0.25), ("CONFIG", 0.15), ("property", 0.08), ("parameter", 0.08), ("animation", 0.12), ("class", 0.12), ("color", 0.04), ("constant", 0.04), ("direction", 0.02), ("pi creature", 0.08), ("custom animation", 0.1)]
