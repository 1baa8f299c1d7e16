from propensa.jobs import main

main()
