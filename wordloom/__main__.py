from wordloom.plans.cli import main

main()
