from cartlens.cli import run

run()
