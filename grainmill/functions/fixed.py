"""Fixed values that results depend on: keyword rules, file names, patterns. All in their natural order."""

# Keyword -> language of a topic; the first that occurs wins.
LANGUAGE_RULES = [
    ("python", "python"),
    ("bash", "bash"), ("shell", "bash"),
    ("node", "nodejs"), ("javascript", "nodejs"),
    ("go ", "go"), ("golang", "go"),
    ("rust", "rust"),
    ("c++", "cpp"), ("cpp", "cpp"),
    (" c ", "c"), ("c program", "c"),
    ("java", "java"),
    ("makefile", "make"), ("cmake", "cmake"),
    ("docker", "docker"),
    ("nginx", "nginx"),
    ("typescript", "typescript"),
]
# File extension -> language.
EXTENSIONS = {
    ".py": "python", ".c": "c", ".h": "c", ".go": "go", ".js": "javascript", ".ts": "typescript",
    ".sh": "bash", ".bash": "bash", ".rb": "ruby", ".rs": "rust", ".java": "java",
}
REQUIRED_FILES = ["task.yaml", "Dockerfile", "run-tests.sh"]
REQUIRED_FIELDS = ["instruction", "difficulty", "parser_name"]
DIFFICULTIES = ["easy", "medium", "hard"]
INFRA_FILES = ["Dockerfile", "docker-compose.yaml", "run-tests.sh", "task.yaml"]
CATEGORIES = ["debugging", "data-processing", "software-engineering", "system-administration", "build-systems", "networking"]
# Signs of a specific instruction: files, functions, bugs, behaviour.
INSTRUCTION_SIGNS = [r"\.\w{1,4}\b", r"\w+\(\)", r"(?i)\b(bug|error|fix|wrong|incorrect|broken|issue)\b", r"(?i)\b(should|must|expected|returns?|outputs?)\b"]
# File writes of a shell script.
WRITES = [r"cat\s+>+\s+(\S+)\s+<<", r"echo\s+[\"'][^\"']*[\"']\s+>\s+(\S+)"]
# Statuses of a test log.
PASSING = ["PASSED", "XFAIL", "SKIPPED"]
FAILING = ["FAILED", "XPASS", "ERROR"]
# Issues that come from the environment, and errors that may pass on a further try (builds, runs).
ENVIRONMENT = ["docker is not available", "image size", "no space left", "disk full", "permission denied"]
TRANSIENT_BUILD = ["connection refused", "daemon is not running", "temporary failure", "could not resolve", "i/o timeout"]
TRANSIENT_RUN = ["connection refused", "daemon is not running", "no space left", "resource temporarily unavailable"]
# Signs of failed tests in a terminal's output, ignoring case.
FAILURE_SIGNS = [
    r"FAILED.*tests?", r"\d+ failed", r"FAIL:", r"Test.*FAILED", r"Error.*test",
    r"make.*Error", r"assertion.*failed", r"exit code [1-9]", r"error:", r"failures?:",
]
# Script writes with their contents: here-document (path, delimiter) and echo (content, path).
HEREDOC = r"""cat\s+>+\s+(\S+)\s+<<\s*['"]?(\w+)['"]?"""
ECHO = r"""echo\s+["']([^"']*)["']\s+>\s+(\S+)"""
# Tokens compared between the two sides of a one-line change.
BOUNDS = r"[<>]=?"
NUMBERS = r"[-+]?\d+"
SHIFTS = r"\w+\s*[-+]\s*1"
OPERATORS = r"[\+\-\*\/\%]|==|!=|<=|>=|<<|>>|\band\b|\bor\b|\bnot\b"
NAMES = r"\b[a-zA-Z_]\w*\b"
STRINGS = r"['\"][^'\"]*['\"]"
GUARDS = ["if ", "elif ", "else:", "try:", "except", "not ", "is None"]
